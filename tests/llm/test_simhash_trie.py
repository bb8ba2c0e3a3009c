"""SimHash tries against the definition of the fingerprint and all pairs of fingerprints."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import simhash_trie as st

LONG = " ".join(f"Wört{i % 977}, été." for i in range(40_000))
ODD = [(1, None), (2, ""), (3, " \n\x0b"), (4, "a"), (5, LONG), (5, LONG), (None, "no id"), (None, "no id"), (9, "A b\x85c  D")]


def naive_print(spark, text):
    """From Spark's own hash of each shingle, one row a shingle."""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if c.isascii() else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [r[0] for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    bits = [sum(h >> k & 1 for h in hashes) * 2 > len(hashes) for k in range(64)]
    value = sum(1 << k for k in range(64) if bits[k])
    return value - (1 << 64) if value >> 63 else value


def brute(rows):
    """Component of each row (position) over all pairs of fingerprints."""
    prints = [p for _, p in rows]
    label = list(range(len(rows)))
    moved = True
    links = [(i, j) for i in range(len(rows)) for j in range(i) if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 4]
    while moved:
        moved = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                moved = True
    groups = {}
    for i, root in enumerate(label):
        groups.setdefault(root, []).append(rows[i][0])
    return [min((x for x in groups[root] if x is not None), default=None) for root in label]


def test_print_is_as_defined(spark):
    for text in ["a", "Ä b C", "one two three four", "x " * 9, "Über the  quick\tbrown fox İ jumps", " ".join(map(str, range(300)))]:
        assert st.simhash(text) == naive_print(spark, text), text
    assert st.simhash(None) == st.simhash(" \n") == 0


@pytest.mark.parametrize("blocks", [6, 7, 8])
def test_orders_share_levels(blocks):
    orders, depth = st.bit_orders(blocks)
    rng = np.random.default_rng(blocks)
    for _ in range(200):
        x = int(rng.integers(0, 2**63))
        y = x
        for bit in rng.choice(64, size=4, replace=False):
            y ^= 1 << int(bit)

        def key(v, order):
            return sum(((v >> shift) & ((1 << size) - 1)) << to for shift, size, to in order)

        assert any(key(x, o) >> (64 - depth) == key(y, o) >> (64 - depth) for o in orders)
        assert all(int(st._restored(np.array([key(x, o)], dtype=np.uint64), o)[0]) == x for o in orders)


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 12)] + [0, 2**64 - 1]
    out = set()
    while len(out) < n:
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 9)):
            value ^= 1 << rng.randrange(64)
        out.add(value - (1 << 64) if value >> 63 else value)
    return sorted(out)


@pytest.mark.parametrize("node_rows", [st.NODE_ROWS, 4])
def test_links_connect_what_all_pairs_connect(spark, node_rows):
    prints = clustered(300, node_rows)
    near = st.near_prints(spark, spark.createDataFrame([(p,) for p in prints], "print long"), node_rows=node_rows)
    links = [tuple(r) for r in near.collect()]
    at = {p: i for i, p in enumerate(prints)}
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(at[a]), root(at[b]))] = min(root(at[a]), root(at[b]))
    assert [root(i) for i in range(len(prints))] == brute(list(enumerate(prints)))


def test_a_dense_node_is_split_and_stays_whole(spark):
    """Hundreds of near fingerprints below one node in most orders."""
    base = 0x0123456789ABCDEF
    star = {base ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(i, 30)}
    far = {~x & (2**64 - 1) for x in list(star)[:50]}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in star | far)
    near = st.near_prints(spark, spark.createDataFrame([(v,) for v in values], "print long"), node_rows=64)
    labels = st.components(spark, near)
    sizes = sorted(r["count"] for r in labels.groupBy("root").count().collect())
    assert sizes == sorted([len(far), len(star)])


def test_odd_rows(spark):
    near = [(20, "one two three four five six"), (21, "one two three four five six"), (2**60 + 1, "lone text of its own here")]
    rows = [*ODD, *near, (2**60 + 2, "another lone text"), (None, "a null beside them")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as print", "2 as fingerprint", "3 as root")
    got = st.near_duplicates(spark, docs.coalesce(1))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    wanted = [(i, st.simhash(t)) for i, t in rows]
    expected = sorted((str(i), f"{p & (2**64 - 1):016x}", str(c)) for (i, p), c in zip(wanted, brute(wanted), strict=True))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got.collect()) == expected
    assert st.near_duplicates(spark, docs.limit(0)).count() == 0


def test_query_against_all_pairs(spark):
    from riskframe.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, st.simhash(t)) for i, t in docs]
    got = LLM_QUERIES["op12_simhash_trie"](spark, folder).collect()
    wanted = sorted((i, f"{p & (2**64 - 1):016x}", c) for (i, p), c in zip(rows, brute(rows), strict=True))
    assert sorted(map(tuple, got)) == wanted
