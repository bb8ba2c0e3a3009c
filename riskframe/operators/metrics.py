"""Binary classification metrics and curves, per group, from one table of scores.

Rows are first aggregated to distinct scores, then running totals along the
scores give ranks, so every metric of every group comes from one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import checked_label, checked_score, safe_ratio
from riskframe.functions.local import local_table
from riskframe.functions.running import bucket_edges, running_totals
from riskframe.session import written

# Fixed value: the machine epsilon of a double, the clip of the log loss.
EPSILON = 2.220446049250313e-16

METRICS = ("precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score", "log_loss")
COUNTS = ("tp", "fp", "tn", "fn")


def confusion(df: DataFrame, label: str = "label", pred: str = "pred",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn and fn per group."""
    base = df.select(*group_cols, checked_label(label).alias("y"), checked_label(pred).alias("p"))
    return base.groupBy(*group_cols).agg(*[F.sum(c).alias(n) for n, c in _confusion_terms().items()])


def _confusion_terms() -> dict[str, Column]:
    y, p = F.col("y"), F.col("p")
    return {"tp": y * p, "fp": (1 - y) * p, "tn": (1 - y) * (1 - p), "fn": y * (1 - p)}


def with_prf(counts: DataFrame) -> DataFrame:
    """Adds precision, recall and F1; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
    })


def prf_metrics(df: DataFrame, label: str = "label", pred: str = "pred",
                group_cols: Sequence[str] = ()) -> DataFrame:
    return with_prf(confusion(df, label, pred, group_cols))


def score_counts(
    df: DataFrame, label: str, proba: str, group_cols: Sequence[str] = (),
    pred: str | None = None, threshold: float = 0.5,
) -> DataFrame:
    """(groups, score, pos, neg, tp, fp, tn, fn): one row per distinct score.

    They are written to the shared folder, so scores are computed and grouped once for edges, ranks and totals.
    """
    score = checked_score(proba)
    decided = checked_label(pred) if pred else (score >= F.lit(threshold)).cast("int")
    base = df.select(*group_cols, score.alias("score"), checked_label(label).alias("y"), decided.alias("p"))
    return written(base.groupBy(*group_cols, "score").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"),
        *[F.sum(c).alias(n) for n, c in _confusion_terms().items()],
    ), "score-counts")


def ranked_scores(counts: DataFrame, group_cols: Sequence[str] = (), lead: bool = False,
                  buckets: int | None = None) -> DataFrame:
    """Score counts with the totals of higher scores; the distinct scores are cut into buckets first."""
    return running_totals(counts, "score", ["pos", "neg"], group_cols, bucket_edges(counts, "score", buckets), lead=lead)


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    proba: str | None = "p",
    pred: str | None = None,
    threshold: float = 0.5,
    group_cols: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """One row per group with all metrics and the confusion counts.

    Score metrics are NULL without scores, or when a group has a single class.
    """
    groups = list(group_cols)
    if proba is None:
        if pred is None:
            raise ValueError("either scores or predictions are needed")
        plain = prf_metrics(df, label, pred, groups)
        return plain.withColumns({m: F.lit(None).cast("double") for m in METRICS[3:]}).select(
            *groups, *METRICS, *COUNTS)

    ranked = ranked_scores(score_counts(df, label, proba, groups, pred, threshold), groups, buckets=buckets)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp_upto = F.col("pos_before") + F.col("pos")
    all_upto = tp_upto + F.col("neg_before") + F.col("neg")
    score = F.col("score")
    clipped = F.least(F.greatest(score, F.lit(EPSILON)), F.lit(1 - EPSILON))
    sums = ranked.groupBy(*groups).agg(
        F.sum(pos).alias("P"), F.sum(neg).alias("N"),
        F.sum(pos * (F.col("neg_before") + neg / 2)).alias("above"),
        F.sum(pos * tp_upto / all_upto).alias("ap"),
        F.sum(pos * (1 - score) * (1 - score) + neg * score * score).alias("squares"),
        F.sum(-(pos * F.ln(clipped) + neg * F.ln(1 - clipped))).alias("losses"),
        *[F.sum(c).alias(c) for c in COUNTS],
    )
    both = (F.col("P") > 0) & (F.col("N") > 0)
    n = F.col("P") + F.col("N")
    return with_prf(sums).withColumns({
        "roc_auc": F.when(both, 1 - F.col("above") / (F.col("P") * F.col("N"))),
        "pr_auc": F.when(both, F.col("ap") / F.col("P")),
        "brier_score": F.when(both, F.col("squares") / n),
        "log_loss": F.when(both, F.col("losses") / n),
    }).select(*groups, *METRICS, *COUNTS)


def roc_curve(df: DataFrame, label: str = "label", proba: str = "p", drop_collinear: bool = True,
              buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) from the start point (infinity, 0, 0) on, thresholds descending.

    With ``drop_collinear`` a point stays only if the step after it differs from
    the step to it; the first and the last score always stay.
    """
    counts = score_counts(df, label, proba)
    ranked = ranked_scores(counts, lead=drop_collinear, buckets=buckets)
    totals = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    # Without any row of a class its rate is not defined.
    P, N = (F.lit(totals[k] or None).cast("double") for k in ("P", "N"))
    points = ranked.withColumns({
        "tpr": (F.col("pos_before") + F.col("pos")) / P,
        "fpr": (F.col("neg_before") + F.col("neg")) / N,
    })
    if drop_collinear:
        first = (F.col("pos_before") + F.col("neg_before")) == 0
        last = F.col("pos_next").isNull()
        bend = (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg"))
        points = points.where(first | last | bend)
    start = local_table(
        df.sparkSession, [(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points.select(F.col("score").alias("threshold"), "fpr", "tpr"))


def pr_curve(df: DataFrame, label: str = "label", proba: str = "p",
             buckets: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point (NULL, 1, 0)."""
    counts = score_counts(df, label, proba)
    ranked = ranked_scores(counts, buckets=buckets)
    positives = counts.agg(F.sum("pos").alias("P")).first()["P"]
    tp = F.col("pos_before") + F.col("pos")
    points = ranked.select(
        F.col("score").alias("threshold"),
        (tp / (tp + F.col("neg_before") + F.col("neg"))).alias("precision"),
        (tp / F.lit(positives) if positives else F.lit(1.0)).alias("recall"),
    )
    end = local_table(
        df.sparkSession, [(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)
