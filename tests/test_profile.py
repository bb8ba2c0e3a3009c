import numpy as np
import pandas as pd
import pytest

from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators import profile


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "x": rng.normal(size=500), "y": rng.integers(0, 7, 500).astype(float), "z": np.ones(500),
        "c": rng.choice(["a", "b", "c"], 500),
    })
    pdf.loc[::7, "x"] = np.nan
    pdf.loc[::5, "y"] = np.nan
    pdf.loc[::9, "c"] = None
    return pdf


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [tuple(None if v is None or v != v else v for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "x double, y double, z double, c string").persist()


def test_numeric_summary_matches_describe(df, frame):
    want = frame[["x", "y", "z"]].describe()
    for r in profile.numeric_summary(df, ["x", "y", "z"]).collect():
        got = [r["n"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
        assert got == pytest.approx(want[r["column"]].tolist(), abs=1e-12)
    assert profile.numeric_summary(df, []).count() == 0


@pytest.mark.parametrize("limit", [1, 20, 1000])
def test_quantiles_are_exact_when_narrowed(df, frame, limit):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["x", "y", "z"], probs, ranked_rows=limit)
    for c in ("x", "y", "z"):
        assert got[c] == pytest.approx(frame[c].quantile(probs).tolist(), abs=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, ["x"], [0.5]) == {"x": [None]}


def test_categorical_summary(df, frame):
    counts = frame["c"].value_counts(dropna=False)
    row = profile.categorical_summary(df, ["c"]).first()
    assert row["n_unique"] == frame["c"].nunique()
    assert row["top_frequency"] == counts.iloc[0]
    assert row["n_missing"] == frame["c"].isna().sum()
    ties = df.sparkSession.createDataFrame([("b",), ("a",)], "c string")
    assert profile.categorical_summary(ties, ["c"]).first()["top_value"] == "a"


def test_category_shares(df, frame):
    want = frame["c"].value_counts(normalize=True)
    rows = profile.category_shares(df, ["c"], top=2).collect()
    assert len(rows) == 2 and {r["n_unique"] for r in rows} == {3}
    for r in rows:
        assert r["share"] == pytest.approx(want[r["value"]])


def test_histogram_matches_numpy(df, frame):
    for c, bins in (("x", 30), ("y", 30), ("z", 30), ("x", 20)):
        want, edges = np.histogram(frame[c].dropna(), bins=bins)
        rows = profile.histogram(df, [c], bins).orderBy("bin").collect()
        assert [r["n"] for r in rows] == want.tolist()
        assert [r["lower"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_correlation_is_pairwise_complete(df, frame):
    want = frame[["x", "y"]].corr()
    for r in profile.correlation(df, ["x", "y"]).collect():
        assert r["correlation"] == pytest.approx(want.loc[r["column_a"], r["column_b"]])


def test_missing_report_is_sorted(df, frame):
    rows = profile.missing_report(df).collect()
    assert [r["column"] for r in rows] == ["y", "x", "c"]
    assert rows[0]["missing_percentage"] == pytest.approx(frame["y"].isna().mean() * 100)


def test_overview(df):
    rows = profile.overview(df).orderBy("position").collect()
    assert [(r["column"], r["dtype"]) for r in rows] == [
        ("x", "double"), ("y", "double"), ("z", "double"), ("c", "string")]
    assert rows[0]["n_rows"] == 500


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 5.0), (3.0, 4.0)], "x double, y double")
    row = profile.numeric_summary(df, ["x"]).first()
    assert (row["n"], row["mean"], row["max"]) == (2, 2.0, 3.0)
    assert sum(r["n"] for r in profile.histogram(df, ["x"]).collect()) == 2
    assert profile.correlation(df, ["x", "y"]).where("column_a <> column_b").first()["correlation"] == pytest.approx(1.0)
