import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.config import CalibrationConfig, ModelConfig
from riskframe.errors import CalibrationError
from riskframe.operators import calibration, models
from conftest import NUMBERS

SIX = list(zip([0, 0, 1, 1, 0, 1], [.4, .3, .6, .55, .45, .7], [.2, .15, .8, .75, .25, .85]))


def plan(name="boosted_trees"):
    return models.model_plan(name, NUMBERS, ["category"], model=ModelConfig(
        boosted_trees_params={"n_estimators": 4, "max_depth": 2, "learning_rate": .2}))


@pytest.mark.parametrize("name,method", [("boosted_trees", "sigmoid"), ("logistic_regression", "isotonic")])
def test_prefit(training, name, method):
    fit = calibration.fit_calibrated(plan(name), training, ["row_id"], CalibrationConfig(method=method))
    rows = fit.calibration_rows
    assert fit.split["n_calib"] == rows.count() == 75 and fit.split["n_fit"] == 225
    assert rows.join(training, "row_id", "left_anti").count() == 0
    ends = fit.calibrated.score(training).agg(F.min("p_calibrated"), F.max("p_calibrated")).first()
    assert 0 <= ends[0] <= ends[1] <= 1


def test_cv_averages_members(training):
    config = CalibrationConfig(strategy="cv", cv_splits=3)
    fit = calibration.fit_calibrated(plan("logistic_regression"), training, ["row_id"], config)
    assert len(fit.calibrated.members) == 3 and fit.split == {"cv_splits": 3, "n_train": 300}
    whole = fit.calibrated.score(training)
    assert set(whole.columns) == {*training.columns, "p_calibrated"}
    single = [calibration.CalibratedModel([m]).score(training, f"m{i}").select("row_id", f"m{i}")
              for i, m in enumerate(fit.calibrated.members)]
    joined = whole
    for s in single:
        joined = joined.join(s, "row_id")
    gap = joined.agg(F.max(F.abs(F.col("p_calibrated") - (F.col("m0") + F.col("m1") + F.col("m2")) / 3))).first()[0]
    assert gap < 1e-12


def test_unsupported_settings(training):
    config = CalibrationConfig()
    config.method = "spline"
    with pytest.raises(CalibrationError):
        calibration.fit_calibrated(plan(), training, ["row_id"], config)
    config = CalibrationConfig()
    config.strategy = "loo"
    with pytest.raises(CalibrationError):
        calibration.fit_calibrated(plan(), training, ["row_id"], config)
    with pytest.raises(CalibrationError):
        calibration.fit_score_calibrator(training.where("label = 1").withColumn("p", F.lit(.5)), "p")


def test_platt_gradient_vanishes(spark):
    rng = np.random.default_rng(5)
    p = rng.random(300).round(2)
    y = (rng.random(300) < p ** 2).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, p double")
    model = calibration.fit_score_calibrator(df, "p")
    got = calibration.calibrate_scores(model, df).collect()
    P, N = y.sum(), len(y) - y.sum()
    target = np.where([r["label"] for r in got], (P + 1) / (P + 2), 1 / (N + 2))
    miss = np.array([r["p_calibrated"] for r in got]) - target
    assert abs(miss.mean()) < 1e-6 and abs((miss * [r["p"] for r in got]).mean()) < 1e-6


def pool(x, y):
    """Pool adjacent violators over distinct, sorted scores."""
    blocks = []
    for v in sorted(set(x)):
        ys = [b for a, b in zip(x, y) if a == v]
        blocks.append([sum(ys), len(ys), [v]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, vs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + vs]
    return {v: s / n for s, n, vs in blocks for v in vs}


def test_isotonic_matches_pooling(spark):
    rng = np.random.default_rng(6)
    x = rng.random(200).round(1)
    y = (rng.random(200) < x).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, x)], "label int, p double")
    model = calibration.fit_score_calibrator(df, "p", "isotonic")
    want = pool(x.tolist(), y.tolist())
    for r in calibration.calibrate_scores(model, df).distinct().collect():
        assert r["p_calibrated"] == pytest.approx(want[r["p"]])
    outside = spark.createDataFrame([(-5.0,), (5.0,)], "p double")
    got = [r["p_calibrated"] for r in calibration.calibrate_scores(model, outside).orderBy("p").collect()]
    assert got == pytest.approx([want[min(want)], want[max(want)]])


def test_compare(spark):
    df = spark.createDataFrame(SIX, "label int, a double, b double")
    row = calibration.compare(df, "a", "b").first()
    y, a, b = map(np.array, zip(*SIX))
    assert row["brier_score_delta"] == pytest.approx(((b - y) ** 2).mean() - ((a - y) ** 2).mean())
    assert row["brier_score_delta"] < 0 and row["log_loss_delta"] < 0 and row["roc_auc_delta"] == 0
    assert row["interpretation"]


def test_reliability_curve(spark):
    rows = [(0, .1, .05), (1, .1, .15), (1, 1.0, .3), (0, 0.0, .30001)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    got = {(r["stage"], r["bin"]): (r["n"], r["observed"]) for r in calibration.reliability_curve(df, "a", "b").collect()}
    # 0.1 and 0.3 are on inner edges and belong to the lower bin; 3 * 0.1 is a bit above 0.3.
    assert got == {("before", 0): (3, 1 / 3), ("before", 9): (1, 1.0), ("after", 0): (1, 0.0),
                   ("after", 1): (1, 1.0), ("after", 2): (1, 1.0), ("after", 3): (1, 0.0)}
    bad = spark.createDataFrame([(0, 1.5, .5)], "label int, a double, b double")
    with pytest.raises(Exception):
        calibration.reliability_curve(bad, "a", "b").collect()


def test_probability_histogram(spark):
    df = spark.createDataFrame(SIX, "label int, a double, b double")
    rows = calibration.probability_histogram(df, "a", "b").collect()
    assert len(rows) == 40
    assert sum(r["n"] for r in rows if r["stage"] == "before") == 6
