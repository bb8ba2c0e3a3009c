"""Probability calibration and its evaluation.

A calibrated model is a Spark ML pipeline that ends in a one-feature model:
logistic regression for the sigmoid method, isotonic regression otherwise. It is
fitted on rows that the base model has not seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.config import CALIBRATION_METHODS, CALIBRATION_STRATEGIES, CalibrationConfig
from riskframe.errors import CalibrationError
from riskframe.functions.columns import checked_label, checked_score, quoted, to_long
from riskframe.operators.isotonic import pooled_blocks
from riskframe.operators.metrics import METRICS, classification_metrics
from riskframe.operators.models import (
    LABEL, SCORE, FittedModel, ModelPlan, fit_folds, in_threads,
)
from riskframe.operators.prep import LINEAR
from riskframe.operators.split import assign_folds, assign_parts

SIGNAL = "__signal"
SIGMOID_OUT = {"rawPredictionCol": "__platt_raw", "probabilityCol": "__platt_probability",
               "predictionCol": "__platt_prediction"}
ISOTONIC_OUT = "__isotonic"
CALIBRATED = "p_calibrated"

READING_NOTE = (
    "A negative Brier or log loss delta means more reliable probabilities. The ROC AUC delta is "
    "shown for completeness: calibration is not meant to improve ranking."
)


def fit_sigmoid(df: DataFrame, signal: str, label: str = LABEL):
    """Platt scaling of a vector column with one element.

    Each row counts towards both classes with Platt's smoothed target as weight.
    The rows are first summed per signal, so repeated scores cost nothing.
    """
    y = checked_label(label)
    summed = df.select(F.col(quoted(signal)).alias(SIGNAL), y.alias("y")).groupBy(SIGNAL).agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).persist()
    totals = summed.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = totals["P"] or 0, totals["N"] or 0
    if not P or not N:
        raise CalibrationError("the calibration rows hold a single class")
    high, low = (P + 1.0) / (P + 2.0), 1.0 / (N + 2.0)
    for_one = F.col("pos") * high + F.col("neg") * low
    weighted = summed.select(SIGNAL, F.inline(F.array(
        F.struct(F.lit(1.0).alias("y"), for_one.alias("w")),
        F.struct(F.lit(0.0).alias("y"), (F.col("pos") + F.col("neg") - for_one).alias("w")),
    )))
    model = LogisticRegression(featuresCol=SIGNAL, labelCol="y", weightCol="w", regParam=0.0,
                               maxIter=200, tol=1e-10, **SIGMOID_OUT).fit(weighted)
    summed.unpersist()
    return model


#: Distinct scores from which they are pooled by ranges; Spark's own fit merges all pools on the driver.
POOLED_ABOVE = 200_000


def fit_isotonic(df: DataFrame, signal: str, label: str = LABEL, pooled_above: int = POOLED_ABOVE):
    """Isotonic regression on distinct scores weighted by their rows.

    It interpolates between scores and clamps outside of them.
    """
    y = checked_label(label)
    summed = df.select(F.col(quoted(signal)).alias(SIGNAL), y.cast("double").alias("y")).groupBy(SIGNAL).agg(
        F.avg("y").alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    row = summed.agg(F.min("y").alias("lo"), F.max("y").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if row["lo"] is None or row["hi"] == 0.0 or row["lo"] == 1.0:
        raise CalibrationError("the calibration rows hold a single class")
    if row["n"] > pooled_above:
        # The ends of the pooled blocks carry the fit; they are what the model holds.
        blocks = pooled_blocks(summed.select(_first(SIGNAL).alias("score"), "y", "w"))
        point = F.struct(F.col("lo").alias("at"), "y", (F.col("w") / 2).alias("w"))
        other = F.struct(F.col("hi").alias("at"), "y", (F.col("w") / 2).alias("w"))
        summed = blocks.select(F.explode(F.array_distinct(F.array(point, other))).alias("p")).select(
            F.col("p.at").alias(SIGNAL), "p.y", "p.w")
    return IsotonicRegression(featuresCol=SIGNAL, labelCol="y", weightCol="w",
                              predictionCol=ISOTONIC_OUT).fit(summed)


def _first(signal: str) -> Column:
    return vector_to_array(signal)[0]


def fit_score_calibrator(df: DataFrame, proba: str, method: str = "sigmoid", label: str = LABEL) -> PipelineModel:
    """A calibrator for a plain score column."""
    if method not in CALIBRATION_METHODS:
        raise CalibrationError(f"unsupported calibration method {method!r}")
    assemble = VectorAssembler(inputCols=[proba], outputCol=SIGNAL, handleInvalid="error")
    rows = assemble.transform(df.select(F.col(quoted(proba)).cast("double").alias(proba), label))
    fit = fit_sigmoid if method == "sigmoid" else fit_isotonic
    return PipelineModel([assemble, fit(rows, SIGNAL, label)])


def calibrate_scores(model: PipelineModel, df: DataFrame, output: str = CALIBRATED) -> DataFrame:
    """Adds the calibrated score; a narrow projection."""
    return _read_output(model.transform(df), output, df.columns)


def _read_output(transformed: DataFrame, output: str, keep: Sequence[str]) -> DataFrame:
    if ISOTONIC_OUT in transformed.columns:
        value = F.col(ISOTONIC_OUT)
    else:
        value = vector_to_array(SIGMOID_OUT["probabilityCol"])[1]
    return transformed.select(*[F.col(quoted(c)) for c in keep], value.alias(output))


def signal_stage(family: str) -> VectorSlicer:
    """What is calibrated: the margin of a linear model, the probability of trees."""
    source = "rawPrediction" if family == LINEAR else "probability"
    return VectorSlicer(inputCol=source, outputCol=SIGNAL, indices=[1])


@dataclass
class CalibratedModel:
    """One calibrated pipeline, or several whose probabilities are averaged."""

    members: list[PipelineModel]

    def score(self, df: DataFrame, output: str = CALIBRATED) -> DataFrame:
        names = [f"__member{i}" for i in range(len(self.members))]
        for name, member in zip(names, self.members):
            df = _read_output(member.transform(df), name, df.columns)
        mean = reduce(Column.__add__, [F.col(n) for n in names]) / F.lit(float(len(names)))
        return df.withColumn(output, mean).drop(*names)


@dataclass
class CalibrationFit:
    """The calibrated model, the raw model for attribution, and the rows safe to evaluate on."""

    calibrated: CalibratedModel
    raw: FittedModel
    strategy: str
    method: str
    split: dict[str, Any] = field(default_factory=dict)
    calibration_rows: DataFrame | None = None


def _calibrated_pipeline(raw: FittedModel, rows: DataFrame, method: str) -> PipelineModel:
    base = PipelineModel([*raw.pipeline().stages, signal_stage(raw.family)])
    fit = fit_sigmoid if method == "sigmoid" else fit_isotonic
    return PipelineModel([*base.stages, fit(base.transform(rows), SIGNAL)])


def fit_calibrated(plan: ModelPlan, train: DataFrame, keys: Sequence[str],
                   config: CalibrationConfig | None = None, parallelism: int = 2) -> CalibrationFit:
    """Fits a calibrated model on training rows.

    ``prefit`` holds out part of the rows for the calibrator. ``cv`` calibrates
    one model per fold on that fold and averages them; the raw model is then one
    more fit on all rows, representative of the members but not one of them.
    """
    config = config or CalibrationConfig()
    if config.method not in CALIBRATION_METHODS:
        raise CalibrationError(f"unsupported calibration method {config.method!r}")
    if config.strategy not in CALIBRATION_STRATEGIES:
        raise CalibrationError(f"unknown calibration strategy {config.strategy!r}")

    if config.strategy == "prefit":
        parts = assign_parts(train, LABEL, keys, config.calibration_holdout_size,
                             seed=config.random_state).persist()
        fit_rows = parts.where("part = 'train'").drop("part")
        calib_rows = parts.where("part = 'test'").drop("part")
        raw = plan.fit_kept(fit_rows)
        members = [_calibrated_pipeline(raw, calib_rows, config.method)]
        sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
        split = {"n_fit": sizes.get("train", 0), "n_calib": sizes.get("test", 0),
                 "calibration_holdout_size": config.calibration_holdout_size}
        parts.unpersist()
        return CalibrationFit(CalibratedModel(members), raw, "prefit", config.method, split, calib_rows)

    folded = assign_folds(train, LABEL, keys, config.cv_splits, config.random_state).persist()
    models = fit_folds(plan, folded, config.cv_splits, parallelism)
    members = in_threads(
        [lambda f=f, m=m: _calibrated_pipeline(m, folded.where(F.col("fold") == f), config.method)
         for f, m in enumerate(models)], parallelism)
    raw = plan.fit_kept(folded)
    split = {"cv_splits": config.cv_splits, "n_train": folded.count()}
    folded.unpersist()
    return CalibrationFit(CalibratedModel(members), raw, "cv", config.method, split, train)


def stages_long(df: DataFrame, before: str, after: str, label: str = LABEL) -> DataFrame:
    """(stage, label, p): both scores of every row, one under the other."""
    renamed = df.select(
        checked_label(label).alias(LABEL),
        checked_score(before).alias("before"), checked_score(after).alias("after"))
    return to_long(renamed, ["before", "after"], keep=[LABEL], as_type="double", name="stage", value=SCORE)


def compare(df: DataFrame, before: str, after: str, label: str = LABEL) -> DataFrame:
    """Metrics at 0.5 before and after calibration on the same rows, and the deltas.

    One row: before_<metric>, after_<metric>, brier_score_delta, log_loss_delta,
    roc_auc_delta.
    """
    metrics = classification_metrics(stages_long(df, before, after, label), group_cols=["stage"])
    picked = [
        F.max(F.when(F.col("stage") == stage, F.col(m))).alias(f"{stage}_{m}")
        for stage in ("before", "after") for m in METRICS
    ]
    return metrics.agg(*picked).withColumns({
        f"{m}_delta": F.col(f"after_{m}") - F.col(f"before_{m}")
        for m in ("brier_score", "log_loss", "roc_auc")
    }).withColumn("interpretation", F.lit(READING_NOTE))


def reliability_curve(df: DataFrame, before: str, after: str, label: str = LABEL, bins: int = 10) -> DataFrame:
    """(stage, bin, n, mean_predicted, observed) over equal-width bins; empty bins are left out.

    A score on an inner edge belongs to the lower bin. Scores outside [0, 1] fail.
    """
    p = F.col(SCORE)
    checked = F.when((p < 0) | (p > 1), F.raise_error(F.lit("scores must be within [0, 1]")).cast("int"))
    edges = [i * (1.0 / bins) for i in range(1, bins)]
    passed = reduce(Column.__add__, [(p > F.lit(e)).cast("int") for e in edges], F.lit(0))
    return (
        stages_long(df, before, after, label)
        .withColumn("bin", F.coalesce(checked, passed))
        .groupBy("stage", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(SCORE).alias("mean_predicted"),
             F.avg(LABEL).alias("observed"))
    )


def probability_histogram(df: DataFrame, before: str, after: str, bins: int = 20) -> DataFrame:
    """(stage, bin, lower, upper, n): the scores before and after over their own range."""
    from riskframe.operators.profile import histogram

    pair = df.select(F.col(quoted(before)).alias("before"), F.col(quoted(after)).alias("after"))
    return histogram(pair, ["before", "after"], bins).withColumnRenamed("column", "stage")
