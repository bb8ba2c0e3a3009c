"""Isotonic fits by ranges against the fit of one list, for every order of violations."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import calibration
from riskframe.operators.isotonic import boundary_pairs, pool, pooled_blocks


def rows_of(kind, n=400):
    rng = random.Random(kind)
    shapes = {
        "rising": lambda i: i / n, "falling": lambda i: -i / n, "noise": lambda i: rng.random(),
        "late low": lambda i: i / n if i < n - 3 else -50.0, "saw": lambda i: (i % 40) / 40, "flat": lambda i: 0.5,
        "trend": lambda i: i / n + rng.gauss(0, 0.3),
    }
    return [(float(i), shapes[kind](i), float(rng.randint(1, 5))) for i in range(n)]


@pytest.mark.parametrize("kind", ["rising", "falling", "noise", "late low", "saw", "flat", "trend"])
def test_ranges_and_one_list_agree(spark, kind):
    rows = rows_of(kind)
    wanted = pool((x, x, y, w) for x, y, w in rows)
    got = pooled_blocks(spark.createDataFrame(rows, "score double, y double, w double").repartition(6), parts=7)
    found = sorted(tuple(r) for r in got.select("lo", "hi", "y", "w").collect())
    assert [r[:2] for r in found] == [tuple(b[:2]) for b in wanted]
    for a, b in zip(found, wanted, strict=True):
        assert a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-12)
    assert all(a[2] < b[2] for a, b in zip(found, found[1:]))


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "score double, y double, w double")
    assert pooled_blocks(empty).count() == 0
    assert [tuple(r)[1:] for r in pooled_blocks(empty.union(empty.selectExpr("score", "y", "w")).union(
        spark.createDataFrame([(1.0, 0.5, 2.0)], "score double, y double, w double"))).collect()] == [(1.0, 1.0, 0.5, 2.0)]


def test_pairs_do_not_overlap():
    ends = [(0, 0.0, 5.0), (1, 4.0, 6.0), (2, 1.0, 2.0), (5, 3.0, 9.0), (7, 1.0, 1.0)]
    assert boundary_pairs(ends) == [(0, 1, 4.0, 5.0), (5, 7, 1.0, 9.0)] or boundary_pairs(ends)[0] == (0, 1, 4.0, 5.0)
    pairs = boundary_pairs(ends)
    used = [x for p in pairs for x in p[:2]]
    assert len(used) == len(set(used))


def test_calibrator_is_the_same_by_both_ways(spark):
    df = spark.range(4000).select(
        ((F.col("id") * 7919) % 3001 / 3001.0).alias("p"), ((F.col("id") * 31) % 97 < F.col("id") % 60).cast("int").alias("label"))
    rows = df.groupBy("p").agg(F.max("label").alias("label"))
    scores = []
    for above in (10_000_000, 0):
        assembler = calibration.VectorAssembler(inputCols=["p"], outputCol=calibration.SIGNAL)
        model = calibration.fit_isotonic(assembler.transform(rows), calibration.SIGNAL, pooled_above=above)
        out = model.transform(assembler.transform(rows)).select("p", calibration.ISOTONIC_OUT)
        scores.append({r[0]: r[1] for r in out.collect()})
    assert scores[0].keys() == scores[1].keys()
    assert max(abs(scores[0][k] - scores[1][k]) for k in scores[0]) < 1e-9
