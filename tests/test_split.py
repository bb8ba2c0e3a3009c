import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.errors import AmbiguousKeyError
from riskframe.operators import split


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(403).select(
        F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("label"),
        (F.col("id") * 1.5).alias("x")).persist()


def parts(df, **kw):
    return {r["k"]: r["part"] for r in split.assign_parts(df, "label", ["k"], **kw).collect()}


def test_exact_sizes_and_balance(rows):
    got = parts(rows)
    labels = {r["k"]: r["label"] for r in rows.collect()}
    counts = Counter((p, labels[k]) for k, p in got.items())
    assert len(got) == 403
    assert counts["test", 0] + counts["test", 1] == math.ceil(0.2 * 403)
    for c in (0, 1):
        assert abs(counts["test", c] - 0.2 * list(labels.values()).count(c)) <= 1


def test_independent_of_partitioning_and_ranking_route(rows):
    base = parts(rows, validation_size=0.15)
    assert base == parts(rows.repartition(7, "x"), validation_size=0.15)
    assert base == parts(rows, validation_size=0.15, ranked_rows=10)
    assert base != parts(rows, validation_size=0.15, seed=7)
    assert Counter(base.values())["validation"] == math.ceil(0.15 * 403)


def test_not_stratified_for_many_values(rows):
    got = split.assign_parts(rows.withColumn("label", F.col("k")), "label", ["k"])
    assert got.where("part = 'test'").count() == math.ceil(0.2 * 403)


def test_key_that_repeats_is_refused(spark):
    same = spark.range(100).select(F.lit(1).alias("k"), (F.col("id") % 2).alias("label"))
    with pytest.raises(AmbiguousKeyError):
        split.assign_parts(same, "label", ["k"]).count()
    with pytest.raises(AmbiguousKeyError):
        split.assign_parts(same, "label", [])
    # Pairs far from any cut are found too.
    twice = spark.range(1000).select((F.col("id") % 500).alias("k"), (F.col("id") % 2).alias("label"))
    with pytest.raises(AmbiguousKeyError):
        split.assign_parts(twice, "label", ["k"])


def test_folds_refuse_a_label_of_many_values(rows):
    with pytest.raises(ValueError, match="classes"):
        split.assign_folds(rows.withColumn("label", F.col("k")), "label", ["k"])


@pytest.mark.parametrize("ranked_rows", [5, 1_000_000])
def test_folds(rows, ranked_rows):
    got = split.assign_folds(rows, "label", ["k"], 5, ranked_rows=ranked_rows).collect()
    sizes = Counter(r["fold"] for r in got)
    assert sorted(sizes) == [0, 1, 2, 3, 4] and max(sizes.values()) - min(sizes.values()) <= 1
    for c in (0, 1):
        per = Counter(r["fold"] for r in got if r["label"] == c)
        assert max(per.values()) - min(per.values()) <= 1


def test_sample_is_exact(rows):
    a = split.sample_rows(rows, 50, ["k"])
    b = split.sample_rows(rows.repartition(3), 50, ["k"], ranked_rows=10)
    assert sorted(r["k"] for r in a.collect()) == sorted(r["k"] for r in b.collect())
    assert a.count() == 50
    assert split.sample_rows(rows, 1000, ["k"]).count() == 403


def test_composite_string_keys(spark):
    df = spark.range(60).select(
        F.concat(F.lit("id-"), (F.col("id") % 10).cast("string")).alias("a"),
        F.floor(F.col("id") / 10).cast("int").alias("b"), (F.col("id") % 2).alias("label"))
    got = split.assign_parts(df, "label", ["a", "b"], 0.25)
    assert got.where("part = 'test'").count() == 15


def test_split_does_not_shuffle_rows(rows):
    plan = split.assign_parts(rows, "label", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_projection(rows):
    got = split.feature_projection(rows.withColumnRenamed("label", "t"), "t", ["x", "nope"])
    assert got.columns == ["k", "label"]
    with pytest.raises(KeyError):
        split.feature_projection(rows, "nope")


def test_balance(rows):
    df = split.assign_parts(rows, "label", ["k"])
    shares = {(r["part"], r["label"]): r["share"] for r in split.part_balance(df, "part", "label").collect()}
    assert shares["train", 1] == pytest.approx(shares["test", 1], abs=0.02)


@given(st.dictionaries(st.integers(0, 9), st.integers(1, 500), min_size=1, max_size=8), st.data())
@settings(max_examples=100, deadline=None)
def test_largest_remainder(counts, data):
    draw = data.draw(st.integers(0, sum(counts.values())))
    share = split.largest_remainder(counts, draw)
    assert sum(share.values()) == draw
    for c, n in counts.items():
        assert 0 <= share[c] <= n
        assert abs(share[c] - draw * n / sum(counts.values())) < 1


@given(st.lists(st.integers(1, 100), min_size=1, max_size=5), st.integers(2, 7))
@settings(max_examples=100, deadline=None)
def test_fold_sizes_deal_rows_out_in_turn(counts, k):
    order = [c for c, n in enumerate(counts) for _ in range(n)]
    want = {c: [order[i::k].count(c) for i in range(k)] for c in range(len(counts))}
    assert split.fold_sizes(dict(enumerate(counts)), k) == want
