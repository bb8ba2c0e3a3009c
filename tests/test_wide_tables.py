"""Tables with many columns, many categories and many rows: one scan, nothing of their size on the driver."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.config import PreprocessingConfig
from riskframe.functions import quantiles
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators import categories, models, prep, profile
from riskframe.operators.categories import CategoryDictionary, WidePreprocessor


def counted(spark, df):
    """``df``, and an accumulator of the rows that all scans of it have read."""
    seen = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(work, df.schema), seen


# ---- quantiles ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(7)
    rows = [(float(a), float(b), None if i % 3 else float(c), 5.0)
            for i, (a, b, c) in enumerate(zip(rng.normal(size=20_000), rng.integers(0, 9, 20_000), rng.exponential(size=20_000)))]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5).persist()


@pytest.mark.parametrize("ranked", [quantiles.RANKED_ROWS, 50])
def test_quantiles_are_exact(numbers, ranked):
    rows, df = numbers
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["a", "b", "c", "d"], probs, ranked_rows=ranked)
    for i, c in enumerate("abcd"):
        values = [r[i] for r in rows if r[i] is not None]
        assert found[c] == pytest.approx(np.quantile(values, probs).tolist(), rel=1e-12, abs=1e-12)


def test_quantiles_of_small_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.0, 0.5, 0.75]) == {"a": [1.0, 2.0, 3.0], "b": [None] * 3}
    assert exact_quantiles(df, [], [0.5]) == {}


def test_a_bracket_that_misses_is_widened(numbers):
    """Wrong values around the quantiles cost scans, not exactness."""
    rows, df = numbers
    found = exact_quantiles(df, ["a"], [0.5], {"a": len(rows)}, around={"a": [3.0, 3.1]})
    assert found["a"] == pytest.approx([float(np.quantile([r[0] for r in rows], 0.5))])


def test_two_scans(spark, numbers):
    rows, df = numbers
    source, seen = counted(spark, df)
    exact_quantiles(source, ["a", "b", "c"], [0.25, 0.5, 0.75])
    assert seen.value == 2 * len(rows)
    source, seen = counted(spark, df)
    profile.numeric_summary(source, ["a", "b", "c"]).collect()
    assert seen.value == 2 * len(rows)


# ---- correlation ---------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1024, 7])
def test_wide_correlation_is_pairwise_complete(spark, block):
    import pandas as pd

    rng = np.random.default_rng(3)
    common = rng.normal(size=(400, 1))
    frame = pd.DataFrame(rng.normal(size=(400, 45)) + common * rng.normal(size=45) + 1e6 * (np.arange(45) % 3 == 0),
                         columns=[f"x {i}" for i in range(45)])
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame["x 43"], frame["x 44"] = 2.0, np.nan
    df = spark.createDataFrame(frame.replace({np.nan: None}), ", ".join(f"`{c}` double" for c in frame)).repartition(70)
    source, seen = counted(spark, df)
    found = {(r[0], r[1]): r[2] for r in profile.wide_correlation(source, list(frame), block).collect()}
    wanted = frame.corr()
    assert len(found) == 45 * 45
    for (a, b), r in found.items():
        w = wanted.loc[a, b]
        assert (r is None and math.isnan(w)) or r == pytest.approx(w, abs=1e-9), (a, b)
    if block > 45:
        assert seen.value == 400
        by_name = {(r[0], r[1]): r[2] for r in profile.correlation(df, list(frame)).collect()}
        assert by_name.keys() == found.keys()


def test_merged_moments_do_not_cancel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 3)) + 1e9
    parts = [profile.block_moments(x[i:i + 100], x[i:i + 100]) for i in range(0, 1000, 100)]
    total = parts[0]
    for part in parts[1:]:
        total = profile.merged_moments(total, part)
    assert total["product"] / 999 == pytest.approx(np.cov(x.T), rel=1e-5)


# ---- categories ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def shop(spark):
    """Two category columns: a third of the rows share one value; many values have one row."""
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"v{rng.randrange(700)}", rng.choice(["x", "y", None]),
             None if i % 11 == 0 else rng.random(), float(rng.random() < (0.8 if i % 3 == 0 else 0.3))) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, item string, kind string, price double, label double")


@pytest.mark.parametrize("broadcast", [categories.BROADCAST_VALUES, 10])
def test_slots_are_the_sorted_places(spark, shop, monkeypatch, broadcast):
    monkeypatch.setattr(categories, "BROADCAST_VALUES", broadcast)
    rows, df = shop
    dictionary = CategoryDictionary.fit(df.where("id < 2000").repartition(9), ["item", "kind"])
    items = sorted({r[1] for r in rows[:2000]})
    assert dictionary.sizes == [len(items), 2]
    mode = max("xy", key=lambda v: (sum(r[2] == v for r in rows[:2000]), v == "x"))
    place = {v: i for i, v in enumerate(items)}
    got = {r["id"]: (r["__slot0"], r["__slot1"]) for r in dictionary.encode(df).collect()}
    assert got == {r[0]: (place.get(r[1]), "xy".index(r[2] or mode)) for r in rows}


def test_a_hot_value_does_not_meet_in_one_task(spark, shop, monkeypatch):
    monkeypatch.setattr(categories, "BROADCAST_VALUES", 10)
    _, df = shop
    dictionary = CategoryDictionary.fit(df, ["item"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in dictionary.encode(df).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 1.3 * 3000 / len(sizes) and len(sizes) == 4


@pytest.mark.parametrize("options", [{}, {"onehot_drop": "first"}, {"onehot_drop": "if_binary"},
                                     {"encode_categorical": "ordinal"}, {"categorical_impute_strategy": "constant"}])
def test_wide_and_listed_preprocessing_agree(spark, shop, options, tmp_path):
    """The same vectors and names, from a table as from lists; saved and loaded too."""
    _, df = shop
    train = df.where("id < 2000")
    listed = prep.fit_preprocessor(train, ["price"], ["item", "kind"], PreprocessingConfig(**options))
    wide = prep.fit_preprocessor(train, ["price"], ["item", "kind"], PreprocessingConfig(listed_categories=5, **options))
    assert isinstance(wide, WidePreprocessor) and isinstance(listed, prep.FittedPreprocessor)
    wide.save(str(tmp_path / "wide"))
    for fitted in (wide, WidePreprocessor.load(str(tmp_path / "wide"))):
        one = {r["id"]: r["features"].toArray() for r in listed.transform(df).select("id", "features").collect()}
        two = {r["id"]: r["features"].toArray() for r in fitted.transform(df).select("id", "features").collect()}
        assert one.keys() == two.keys()
        assert all(np.allclose(one[k], two[k], atol=1e-12) for k in one)
        names = [tuple(r) for r in fitted.feature_map(spark).orderBy("slot").collect()]
        assert names == [tuple(r) for r in listed.feature_map(spark).orderBy("slot").collect()]


def test_unknown_categories_can_stop_the_scoring(spark, shop):
    _, df = shop
    config = PreprocessingConfig(listed_categories=5, handle_unknown_categorical="error")
    wide = prep.fit_preprocessor(df.where("id < 2000"), ["price"], ["item"], config)
    with pytest.raises(Exception, match="unknown category in column item"):
        wide.transform(df)


def test_a_linear_model_fits_and_scores_on_a_dictionary(spark, shop):
    _, df = shop
    scores = []
    for listed in (100_000, 5):
        plan = models.model_plan("logistic_regression", ["price"], ["item", "kind"], PreprocessingConfig(listed_categories=listed))
        model = plan.fit(df)
        scores.append({r["id"]: r["proba"] for r in model.score(df, "proba").select("id", "proba").collect()})
    assert scores[0].keys() == scores[1].keys()
    assert max(abs(scores[0][k] - scores[1][k]) for k in scores[0]) < 1e-4
    with pytest.raises(ValueError, match="is no pipeline"):
        model.pipeline()
