import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.config import CVConfig, ModelConfig, TuningConfig
from riskframe.operators import models, tuning
from riskframe.operators.prep import FEATURES
from conftest import NUMBERS

SMALL = {"n_estimators": 5, "max_depth": 2, "learning_rate": 0.2}


def plan(name, **config):
    return models.model_plan(name, NUMBERS, ["category"], model=ModelConfig(boosted_trees_params=dict(SMALL), **config))


@pytest.mark.parametrize("name", ["logistic_regression", "boosted_trees"])
def test_fit_and_score(training, name):
    rows = plan(name).fit(training).score(training)
    assert rows.count() == 300 and set(rows.columns) == {*training.columns, "p"}
    ends = rows.agg(F.min("p"), F.max("p")).first()
    assert 0 <= ends[0] < ends[1] <= 1


def test_logistic_regression_is_at_its_optimum(training):
    fitted = plan("logistic_regression").fit(training)
    rows = fitted.prep.transform(fitted.score(training)).select(
        vector_to_array(FEATURES).alias("x"), "label", "p").collect()
    x = np.array([r["x"] for r in rows])
    miss = np.array([r["p"] - r["label"] for r in rows])
    w = np.array(fitted.classifier.coefficients)
    assert x.T @ miss + w == pytest.approx(np.zeros(len(w)), abs=1e-3)
    assert miss.sum() == pytest.approx(0, abs=1e-3)


def test_class_ratio_and_weights(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "label double")
    assert models.scale_pos_weight(df) == 3.0
    assert models.class_weights(df, "balanced") == {0.0: 4 / 6, 1.0: 2.0}
    assert models.class_weights(df, "scale_pos_weight") == {0.0: 1.0, 1.0: 3.0}
    with pytest.raises(ValueError):
        models.scale_pos_weight(df.where("label = 0"))


def test_imbalance_is_opt_in(training, caplog):
    assert not plan("logistic_regression").balanced
    assert plan("logistic_regression", class_imbalance_strategy="balanced").balanced
    assert plan("logistic_regression", class_imbalance_strategy="class_weight").balanced
    weighted = models.model_plan(
        "boosted_trees", NUMBERS, ["category"], train=training,
        model=ModelConfig(class_imbalance_strategy="scale_pos_weight", boosted_trees_params=dict(SMALL)))
    assert weighted.positive_weight == models.scale_pos_weight(training)
    assert weighted.fit(training).score(training).agg(F.avg("p")).first()[0] > 0
    with pytest.raises(ValueError):
        plan("boosted_trees", class_imbalance_strategy="scale_pos_weight")
    assert plan("boosted_trees", class_imbalance_strategy="balanced").positive_weight is None
    assert "ignored" in caplog.text


def test_balanced_weights_raise_scores(training):
    rare = training.where("label = 0 or row_id % 4 = 0")
    mean = {
        s: plan("logistic_regression", class_imbalance_strategy=s).fit(rare).score(rare).agg(F.avg("p")).first()[0]
        for s in (None, "balanced")}
    assert mean["balanced"] > mean[None]


def test_unknown_model():
    with pytest.raises(ValueError):
        plan("forest")


def test_cross_validation(training):
    result = models.cross_validate(plan("logistic_regression"), training, ["row_id"], CVConfig(n_splits=3))
    folds = result.fold_metrics.toPandas()
    assert sorted(folds["fold"]) == [0, 1, 2]
    for m in ("roc_auc", "f1", "log_loss"):
        assert result.mean_metrics[m] == pytest.approx(folds[m].mean())
        assert result.std_metrics[m] == pytest.approx(folds[m].std())
    assert result.oof.select("row_id").distinct().count() == result.oof.count() == 300
    assert result.mean_metrics["roc_auc"] > 0.7
    again = models.validation_scores(plan("logistic_regression"), training, ["row_id"], CVConfig(n_splits=3))
    both = again.join(result.oof.withColumnRenamed("p", "q"), "row_id").agg(F.max(F.abs(F.col("p") - F.col("q"))))
    assert both.first()[0] < 1e-9


def test_holdout_scores(training):
    rows = models.validation_scores(plan("logistic_regression"), training, ["row_id"], strategy="holdout", holdout_size=0.25)
    assert rows.count() == 75
    with pytest.raises(ValueError):
        models.validation_scores(plan("logistic_regression"), training, ["row_id"], strategy="nope")


def test_undefined_folds_do_not_count(spark):
    folds = spark.createDataFrame(
        [(0, .5), (1, None), (2, .7)], "fold int, roc_auc double").withColumns(
        {m: F.lit(1.0) for m in models.METRICS if m != "roc_auc"})
    row = models.summarise_folds(folds).first()
    assert row["cv_roc_auc"] == pytest.approx(.6) and row["cv_roc_auc_std"] == pytest.approx(np.std([.5, .7], ddof=1))


def test_search(training, tmp_path):
    config = TuningConfig(n_iter=3, n_splits=3, param_distributions={
        "n_estimators": [2, 4], "max_depth": [2, 3], "learning_rate": [.1, .2]})
    result = tuning.random_search(plan("boosted_trees"), training, ["row_id"], config)
    rows = tuning.top_candidates(result).collect()
    assert len(rows) == 3 and rows[0]["rank"] == 1
    assert result.best_score == max(r["mean_test_score"] for r in rows)
    assert result.train_val_gap == pytest.approx(rows[0]["mean_train_score"] - rows[0]["mean_test_score"])
    assert result.oof.count() == 300
    assert tuning.draw_candidates(config.param_distributions, 3, 42) == tuning.draw_candidates(config.param_distributions, 3, 42)
    assert len(tuning.draw_candidates(config.param_distributions, 99, 1)) == 8
    # The scores of the shared folds are those of plain cross-validation.
    cv = models.cross_validate(result.best_plan, training, ["row_id"], CVConfig(n_splits=3))
    assert cv.mean_metrics["roc_auc"] == pytest.approx(result.best_score)
    saved = tuning.save_tuning(result, str(tmp_path / "m"), str(tmp_path / "d"), "v1")
    assert set(saved) == {"model", "cv_results", "metadata"}


def test_comparison_allows_missing_validation(spark):
    row = spark.createDataFrame([(.7,)], "cv_roc_auc double")
    validation = spark.createDataFrame([tuple([.5] * 7)], ", ".join(f"{m} double" for m in models.METRICS))
    table = models.comparison([
        models.ComparisonEntry("a", row, 1.0), models.ComparisonEntry("b", row, 2.0, validation, ["note"])])
    got = {r["model_name"]: r for r in table.collect()}
    assert got["a"]["val_roc_auc"] is None and got["b"]["val_roc_auc"] == .5
