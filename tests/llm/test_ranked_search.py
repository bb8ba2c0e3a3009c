"""Ranked search against a scan of all documents, and bounds against scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskframe.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def terms_of(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, top=10):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        rows = []
        for doc, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if t in c)
            if score > 0:
                rows.append((-score, doc is None, doc))
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, k + 1, r[2], -r[0]) for k, r in enumerate(rows[:top])]
    return sorted(out, key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "日本", "x2"]
    return [(i, " ".join(rng.choices(vocabulary[:rng.choice([20, 400])] + vocabulary[-3:], k=rng.randint(1, 200))))
            for i in range(n)]


ODD = [(None, "w1 w2 w3"), (None, "W1, w2; w3"), (None, None), (7001, ""), (7002, " .,; "), (7003, None),
       (2**60 + 1, "w1 w2"), (2**60 + 2, "w2 w1"), (5, "w5 w6"), (5, "w5 w6"), (6, "É" * 40),
       (8, " ".join(f"w{i % 50} LONG{i}" for i in range(30_000)))]


@pytest.mark.parametrize("pass_bytes", [rs.PASS_BYTES, 6000])
def test_search_against_all_documents(spark, pass_bytes):
    docs = corpus(300, 3) + ODD
    items = [(i, t) for i, t in corpus(12, 4)] + [
        (90, None), (91, ""), (92, "nowhere"), (None, "w1 w2 w3"), (93, "É w2"), (93, "é w3"), (94, "long7 w3 w3"),
        (95, docs[17][1]), (95, docs[17][1])]
    got = rs.search(spark, spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' as hash", "1 as items").repartition(3),
                    spark.createDataFrame(items, SCHEMA).selectExpr("doc_id as item_id", "text", "2 as doc_id", "3 as item"),
                    pass_bytes=pass_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(corpus(5, 1), SCHEMA), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert rs.search(spark, docs.limit(0), items).count() == 0
    assert rs.search(spark, docs, items.limit(0)).count() == 0


def test_bounds_hold_and_are_close():
    """No score exceeds its bound; most bounds equal the score of terms as often as the levels tell."""
    docs = corpus(300, 9) + [(1, "w3 " * 700), (2, " ".join(["w5"] * 5000 + ["w6"]))]
    items = rs.Items.of(corpus(40, 10))
    counted = [rs.term_counts(t) for _, t in docs]
    items.n_docs, items.total = len(docs), int(sum(c.sum() for _, c in counted))
    items.weights = np.random.default_rng(0).integers(0, 5000, len(items.terms))
    for bits in (1 << 8, 1 << 13, 1 << 16):
        rows = [(0, 0, int(c.sum()), rs.entered_keys(t, c)) for t, c in counted]
        block = rs._block(bits, rows)
        grid = np.frombuffer(block.column("slices")[0].as_buffer(), dtype=np.uint8).reshape(bits, -1)
        sizes = np.array([r[2] for r in rows])
        bound = rs.upper_bounds(items, bits, sizes, grid)
        exact = np.zeros_like(bound)
        for d, (terms, counts) in enumerate(counted):
            hit, place = items.found(terms)
            gains = np.zeros(len(items.terms), dtype=np.int64)
            gains[place] = rs.gain(counts[hit], rs.length_part(np.array(counts.sum()), items.n_docs, items.total))
            exact[:, d] = [items.weights[p] @ gains[p] for p in items.places]
        assert (bound >= exact).all()
    assert bound.sum() < 1.1 * exact.sum()


def test_terms_are_as_defined():
    for text in ["A-b_c d9É日本\x85x", "x", "..", "", "É.é;\x7fZ", "ǅa İI"]:
        words = terms_of(text)
        hashes = rs.term_hashes(text)
        assert len(hashes) == len(words)
        assert len({*hashes.tolist()}) == len({*words})
        assert [rs.term_hashes(w)[0] for w in words] == hashes.tolist()


def test_query_against_all_documents(spark):
    from riskframe.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, LLM_QUERIES["op13_bloom_search"](spark, folder).collect()), key=str) == brute(docs, items)
