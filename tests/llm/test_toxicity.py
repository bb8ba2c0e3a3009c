"""Weak supervision: posteriors stay with their labels, held-out rows are told apart in every language, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import toxicity
from riskframe.llm.common import fold_of

FOLDER = "/root/testdata/sf0.1"


def test_posteriors_stay_on_their_labels_side():
    """Voters that agree with each other but not with the class, as on words of one language, do not win it over."""
    rng = np.random.default_rng(3)
    labels = (rng.random(3000) < 0.1).astype(int)
    topic = rng.random(3000) < 0.2
    topic_votes = topic[:, None] & (rng.random((3000, 60)) < 0.9)
    good = np.where(labels[:, None] == 1, rng.random((3000, 8)) < 0.6, rng.random((3000, 8)) < 0.02)
    fired = np.column_stack([topic_votes, good]).astype(np.float32)
    posterior = toxicity.label_model(fired, labels)
    assert (posterior[labels == 1] > 0.5).mean() > 0.97 and (posterior[labels == 0] < 0.5).mean() > 0.99


def test_blocks_and_discounts_of_copied_voters():
    """Copies of a voter are one block and weigh about as one."""
    rng = np.random.default_rng(4)
    labels = (rng.random(4000) < 0.2).astype(int)
    one = np.where(labels == 1, rng.random(4000) < 0.5, rng.random(4000) < 0.1).astype(np.float32)
    single = toxicity.label_model(one[:, None], labels, (0.7, 0.3))
    copied = toxicity.label_model(np.repeat(one[:, None], 30, axis=1), labels, (0.7, 0.3))
    assert np.abs(single - copied).max() < 0.05
    assert toxicity.blocks_of(np.array([[0, 0.5, 0], [0.5, 0, 0], [0, 0, 0.0]])).tolist() == [0, 0, 2]


def test_held_out_rows_in_every_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held_out = fold_of("doc_id", 3) == 1
    model = toxicity.fit_toxicity(docs, labels, ~held_out)
    scored = toxicity.score_toxicity(spark, docs.where(held_out).join(labels, "doc_id"), model)
    rows = scored.groupBy("lang", "toxic").agg(F.avg("predicted").alias("share")).collect()
    shares = {(r["lang"], r["toxic"]): r["share"] for r in rows}
    for lang in ("en", "de", "es", "fr"):
        assert shares[lang, 1] >= 0.75 and shares[lang, 0] <= 0.02, shares


def test_stem_votes_and_patterns():
    words = ["stem" + x for x in "abcdefgh"] + ["no"] * 30
    found = toxicity.patterns_of(words)
    assert {"ste*c8", "stem*c8", "no=", "ste*s200"} <= found and "ste*c13" not in found
    voters = toxicity.Voters(("ste*c8", "ste*s200", "no=", "ste*c13"))
    known = voters.index()
    fired = {voters.names[i] for i in voters.votes(" ".join(words), known)}
    assert fired == {"ste*c8", "ste*s200", "no=", "any_pattern", "two_patterns"}


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, "plain words about nothing much here" + (" vileword badly vileness" if i % 5 == 0 else f" w{i}"),
             int(i % 5 == 0)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (9999, None)], "doc_id long, toxic int")


def test_odd_rows_and_clashing_columns(spark, small):
    docs, labels = small
    model = toxicity.fit_toxicity(docs, labels)
    odd = [(None, None), (1, ""), (1, ""), (2, " \n"), (3, "vileword badly vileness " * 100_000), (2**60 + 1, "plain words")]
    rows = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "7 as score", "8 as label", "9 as fired")
    got = toxicity.score_toxicity(spark, rows.coalesce(1), model)
    assert sorted(got.columns) == sorted(["doc_id", "text", "label", "fired", "score", "predicted"])
    assert sorted(((str(r["doc_id"]), r["predicted"]) for r in got.collect())) == sorted(
        [("None", 0), ("1", 0), ("1", 0), ("2", 0), ("3", 1), (str(2**60 + 1), 0)])
    assert toxicity.score_toxicity(spark, rows.limit(0), model).count() == 0


def test_stage_drops_toxic_rows_only(spark, small):
    docs, labels = small
    docs = docs.withColumns({"score": F.lit("kept"), "__row": F.lit(1)})
    kept = toxicity.drop_toxic(spark, docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(300) if i % 5}
    assert toxicity.drop_toxic(spark, docs.limit(0), labels).count() == 0
    assert toxicity.drop_toxic(spark, docs, labels.limit(0)).count() == 300
