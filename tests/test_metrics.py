import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskframe.operators import metrics, threshold

EPS = np.finfo(float).eps


def brute(rows):
    """Metrics by their definitions: all pairs for the ROC area, a step sum for average precision."""
    y = np.array([r[0] for r in rows], float)
    p = np.array([r[1] for r in rows], float)
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        return None
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / len(pos)
        ap += (recall - last) * y[hit].mean()
        last = recall
    q = np.clip(p, EPS, 1 - EPS)
    return {
        "roc_auc": wins / (len(pos) * len(neg)), "pr_auc": ap, "brier_score": ((p - y) ** 2).mean(),
        "log_loss": -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean(),
    }


def frame(spark, rows):
    return spark.createDataFrame([(int(y), float(p)) for y, p in rows], "label int, p double")


score_rows = st.lists(
    st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.3, 0.5, 0.77, 0.9, 1.0])),
    min_size=2, max_size=40)


@given(rows=score_rows, limit=st.sampled_from([2, 50]))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_metrics_match_brute_force(spark, rows, limit):
    got = metrics.classification_metrics(frame(spark, rows), buckets=limit).first()
    want = brute(rows)
    for m in ("roc_auc", "pr_auc", "brier_score", "log_loss"):
        if want is None:
            assert got[m] is None
        else:
            assert got[m] == pytest.approx(want[m], abs=1e-12)


def test_bucketed_ranking_is_the_same_per_group(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 2)), float(round(rng.random(), 2)), int(rng.integers(0, 3))) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, p double, g int")
    one = metrics.classification_metrics(df, group_cols=["g"]).orderBy("g").collect()
    two = metrics.classification_metrics(df, group_cols=["g"], buckets=13).orderBy("g").collect()
    for a, b in zip(one, two):
        want = brute([r[:2] for r in rows if r[2] == a["g"]])
        for m in want:
            assert a[m] == pytest.approx(want[m]) and b[m] == pytest.approx(want[m])
    a = metrics.roc_curve(df).orderBy("threshold").collect()
    b = metrics.roc_curve(df, buckets=13).orderBy("threshold").collect()
    assert [tuple(map(lambda v: round(v, 9), r)) for r in a] == [tuple(map(lambda v: round(v, 9), r)) for r in b]


def test_perfect_scores(spark):
    df = spark.createDataFrame([(0, 0, .1), (0, 0, .2), (1, 1, .8), (1, 1, .9)], "label int, pred int, p double")
    row = metrics.classification_metrics(df, pred="pred").first()
    assert [row[m] for m in ("precision", "recall", "f1", "roc_auc", "pr_auc")] == [1.0] * 5


def test_single_class_and_no_scores(spark):
    df = spark.createDataFrame([(0, 0, .1), (0, 1, .6)], "label int, pred int, p double")
    row = metrics.classification_metrics(df, pred="pred").first()
    assert row["precision"] == 0.0 and row["roc_auc"] is None and row["log_loss"] is None
    row = metrics.classification_metrics(df, proba=None, pred="pred").first()
    assert row["roc_auc"] is None and row["fp"] == 1


def test_confusion(spark):
    df = spark.createDataFrame(list(zip([0, 1, 1, 0, 1], [0, 1, 0, 0, 1])), "label int, pred int")
    assert metrics.confusion(df).first().asDict() == {"tp": 2, "fp": 0, "tn": 2, "fn": 1}


@pytest.mark.parametrize("rows", [[(None, 0.5)], [(1, None)], [(2, 0.5)]])
def test_missing_or_foreign_values_fail(spark, rows):
    df = spark.createDataFrame(rows, "label int, p double")
    with pytest.raises(Exception):
        metrics.classification_metrics(df).collect()


def test_roc_curve_drops_collinear_points(spark):
    df = frame(spark, [(1, .9), (1, .8), (1, .7), (0, .6), (0, .5), (1, .4)])
    full = metrics.roc_curve(df, drop_collinear=False).collect()
    assert len(full) == 7 and math.isinf(max(r["threshold"] for r in full))
    kept = sorted((-r["threshold"], r["fpr"], r["tpr"]) for r in metrics.roc_curve(df).collect())
    assert [(-t, f, r) for t, f, r in kept] == [
        (math.inf, 0.0, 0.0), (.9, 0.0, .25), (.7, 0.0, .75), (.5, 1.0, .75), (.4, 1.0, 1.0)]


def test_pr_curve(spark):
    df = frame(spark, [(1, .9), (0, .8), (1, .8), (0, .1)])
    points = {r["threshold"]: (r["precision"], r["recall"]) for r in metrics.pr_curve(df).collect()}
    assert points == {.9: (1.0, .5), .8: (2 / 3, 1.0), .1: (.5, 1.0), None: (1.0, 0.0)}


@given(rows=score_rows)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_sweep_matches_direct_counts(spark, rows):
    y = np.array([r[0] for r in rows])
    p = np.array([r[1] for r in rows])
    for r in threshold.sweep(frame(spark, rows)).collect():
        hit = p >= r["threshold"]
        assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (
            (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 0)).sum(), (~hit & (y == 1)).sum())
