"""Threshold sweep and selection."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.config import THRESHOLD_STRATEGIES
from riskframe.errors import ThresholdSelectionError
from riskframe.functions.columns import checked_label, checked_score, quoted, safe_ratio
from riskframe.functions.local import local_table
from riskframe.operators.metrics import with_prf
from riskframe.sources.sinks import read_json, write_json, write_table

DEFAULT_THRESHOLDS = tuple(round(i / 100, 2) for i in range(1, 100))
SWEEP_COLUMNS = ("threshold", "precision", "recall", "f1", "tp", "fp", "tn", "fn")


def sweep(df: DataFrame, label: str = "label", proba: str = "p",
          thresholds: Sequence[float] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Counts, precision, recall and F1 at every threshold, from one pass over the rows.

    A row lands in the bucket that counts the thresholds it reaches; summing the
    buckets from above gives the positives at each threshold.
    """
    grid = sorted({check_threshold(float(t)) for t in thresholds})
    spark = df.sparkSession
    splits = [float("-inf"), *grid, float("inf")]
    base = df.select(checked_label(label).alias("y"), checked_score(proba).alias("score"))
    bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="reached").transform(base)
    counts = bucketed.groupBy("reached").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    # At most one row per threshold on both sides from here on.
    frame = local_table(
        spark, [(float(i), t) for i, t in enumerate([None, *grid])], "reached double, threshold double")
    order = Window.orderBy(F.col("reached").desc())
    whole = Window.partitionBy()
    filled = frame.join(F.broadcast(counts), "reached", "left").fillna(0, ["pos", "neg"])
    swept = filled.withColumns({
        "tp": F.sum("pos").over(order), "fp": F.sum("neg").over(order),
        "P": F.sum("pos").over(whole), "N": F.sum("neg").over(whole),
    }).withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
    return with_prf(swept.where("threshold is not null")).select(*SWEEP_COLUMNS)


def _ranking(strategy: str, kw: dict[str, Any]) -> tuple[Column | None, list[Column], str]:
    """Floor, order and rationale of a strategy."""
    if strategy == "maximize_f1":
        return None, [F.col("f1").desc()], (
            "Highest F1, the balance of precision and recall; the neutral choice when no cost "
            "and no floor is documented.")
    if strategy == "min_recall":
        floor = kw["min_recall"]
        return F.col("recall") >= floor, [F.col("precision").desc()], (
            f"Highest precision among thresholds with recall of at least {floor}.")
    if strategy == "min_precision":
        floor = kw["min_precision"]
        return F.col("precision") >= floor, [F.col("recall").desc()], (
            f"Highest recall among thresholds with precision of at least {floor}.")
    if strategy == "cost_based":
        fp, fn = kw["cost_fp"], kw["cost_fn"]
        return None, [(F.col("fp") * fp + F.col("fn") * fn).asc()], (
            f"Lowest total cost with {fp} per false positive and {fn} per false negative.")
    if strategy == "youden_j":
        gain = F.col("recall") - safe_ratio(F.col("fp"), F.col("fp") + F.col("tn"))
        return None, [gain.desc()], "Highest recall minus false positive rate."
    wanted = kw["fixed_threshold"]
    return None, [F.abs(F.col("threshold") - wanted)], f"The given threshold {wanted}."


def select_threshold(table: DataFrame, strategy: str = "maximize_f1", **kw: float) -> DataFrame:
    """The chosen row of a sweep: threshold, strategy, rationale and metrics.

    Ties go to the smallest threshold. A ``fixed`` threshold has to be in the sweep.
    """
    if strategy not in THRESHOLD_STRATEGIES:
        raise ValueError(f"unknown threshold strategy {strategy!r}; known: {THRESHOLD_STRATEGIES}")
    floor, order, rationale = _ranking(strategy, kw)
    candidates = table if floor is None else table.where(floor)
    if strategy == "fixed":
        check_threshold(kw["fixed_threshold"])
        candidates = candidates.where(F.col("threshold") == float(kw["fixed_threshold"]))
    best = candidates.orderBy(*order, F.col("threshold").asc()).limit(1).collect()
    if not best:
        raise ThresholdSelectionError(f"no threshold of the sweep satisfies {strategy} with {kw}")
    row = best[0]
    return local_table(
        table.sparkSession, [(row["threshold"], strategy, rationale, *[row[c] for c in SWEEP_COLUMNS[1:]])],
        "threshold double, strategy string, rationale string, precision double, recall double, "
        "f1 double, tp bigint, fp bigint, tn bigint, fn bigint")


def choose(df: DataFrame, strategy: str, label: str = "label", proba: str = "p",
           thresholds: Sequence[float] = DEFAULT_THRESHOLDS, **kw: float) -> tuple[DataFrame, DataFrame]:
    """Sweep and selection together; a fixed threshold is swept even off the grid."""
    grid = [kw["fixed_threshold"]] if strategy == "fixed" else thresholds
    table = sweep(df, label, proba, grid)
    return table, select_threshold(table, strategy, **kw)


def check_threshold(threshold: float) -> float:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError(f"a threshold must be within [0, 1], got {threshold}")
    return float(threshold)


def apply_threshold(df: DataFrame, threshold: float, proba: str = "p", pred: str = "prediction") -> DataFrame:
    """Adds the decision: 1 where the score reaches the threshold."""
    check_threshold(threshold)
    return df.withColumn(pred, (F.col(quoted(proba)) >= F.lit(float(threshold))).cast("int"))


def tradeoff_table(table: DataFrame, threshold: float) -> DataFrame:
    """The sweep with the row nearest to the chosen threshold marked."""
    distance = F.abs(F.col("threshold") - F.lit(float(threshold)))
    order = Window.orderBy(distance, "threshold")
    return table.withColumn("selected", F.row_number().over(order) == 1)


def save_threshold(result: DataFrame, table: DataFrame, uri: str,
                   metadata: dict[str, Any] | None = None) -> dict[str, str]:
    row = result.first().asDict()
    document = {
        "threshold": row["threshold"], "strategy": row["strategy"], "rationale": row["rationale"],
        "metrics_at_threshold": {c: row[c] for c in SWEEP_COLUMNS[1:]},
        "metadata": metadata or {},
    }
    return {
        "threshold": write_json(result.sparkSession, document, f"{uri}/threshold"),
        "table": write_table(table, f"{uri}/evaluation_table"),
    }


def load_threshold(spark: SparkSession, uri: str) -> dict[str, Any]:
    return read_json(spark, f"{uri}/threshold")
