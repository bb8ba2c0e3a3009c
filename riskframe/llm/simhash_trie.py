"""SimHash near-duplicates: binary tries over fingerprints joined with themselves, node pair by node pair."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import settle
from riskframe.llm.components import components

SHINGLE_WORDS, BITS, BUDGET, SEED = 4, 64, 4, 42
#: Members of a trie node that one task joins at once; larger nodes are split into pairs of their children.
NODE_ROWS = 2048
#: Levels by which a large node is split.
STEP = 6
#: Distinct fingerprints up to which so many blocks are used; every choice finds all links.
BLOCKS_UP_TO = ((6, 1 << 24), (7, 1 << 30), (8, None))
#: Member pairs below which a node pair is compared directly, and member pairs in memory at once.
_LEAF, _WORK = 16, 1 << 22
_CHUNK = 1 << 15


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint as a signed number: a bit is set if more than half of the shingle hashes set it."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(words, len(parts))
    first, last = starts[:len(parts) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(first), _CHUNK):
        hashes = [digest(joined[s:e], SEED)
                  for s, e in zip(first[at:at + _CHUNK], last[at:at + _CHUNK], strict=True)]
        counts += np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, BITS).sum(
                axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(first)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, print`` of each whole text, computed where it is read."""
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(text, words) for text in texts.tolist()], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("print"))


# ---- orders of the bits ----------------------------------------------------------------------


def bit_orders(blocks: int, budget: int = BUDGET) -> tuple[list[list[tuple[int, int, int]]], int]:
    """Orders of the bits, and the levels on which a linked pair agrees in at least one of them.

    The bits are cut into ``blocks``; of two fingerprints that differ in at most ``budget``
    bits, ``blocks - budget`` blocks are equal. Each order puts so many blocks first. A
    block is given as (its shift, its bits, its shift in the new order).
    """
    sizes = [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]
    shifts = [BITS - sum(sizes[:i + 1]) for i in range(blocks)]
    orders = []
    for first in combinations(range(blocks), blocks - budget):
        order, left = [], BITS
        for block in [*first, *[i for i in range(blocks) if i not in first]]:
            left -= sizes[block]
            order.append((shifts[block], sizes[block], left))
        orders.append(order)
    return orders, sum(sorted(sizes)[:blocks - budget])


def _ordered(value: Column, order: list[tuple[int, int, int]]) -> Column:
    key = None
    for shift, size, to in order:
        part = F.shiftleft(F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << size) - 1)), to)
        key = part if key is None else key.bitwiseOR(part)
    return key


def _restored(keys: np.ndarray, order: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(len(keys), dtype=np.uint64)
    for shift, size, to in order:
        out |= ((keys >> np.uint64(to)) & np.uint64((1 << size) - 1)) << np.uint64(shift)
    return out


# ---- the join of a trie with itself ------------------------------------------------------------


def trie_pairs(keys: np.ndarray, starts: np.ndarray, depth: int, budget: int = BUDGET) -> Iterator[tuple]:
    """Positions ``i, j`` of the members of each run that differ in at most ``budget`` bits.

    ``keys`` are sorted inside each run, so that a trie node is a range of positions and its
    children are what lies before and after the first set bit. Pairs of nodes, at first each
    run's root with itself, descend together from level ``depth``; a step to different
    children adds a differing bit, and pairs beyond the budget are dropped.
    """
    ends = np.r_[starts[1:], len(keys)]
    large = ends - starts > 1
    a0 = b0 = starts[large]
    a1 = b1 = ends[large]
    apart = np.zeros(len(a0), dtype=np.int8)
    for level in range(depth, BITS + 1):
        cells = (a1 - a0) * (b1 - b0)
        leaf = cells <= _LEAF if level < BITS else np.ones(len(cells), dtype=bool)
        if leaf.any():
            cells, wide, at_a, at_b = cells[leaf], (b1 - b0)[leaf], a0[leaf], b0[leaf]
            first = np.r_[0, np.cumsum(cells)[:-1]]
            cell = np.arange(cells.sum()) - np.repeat(first, cells)
            wide = np.repeat(wide, cells)
            i, j = np.repeat(at_a, cells) + cell // wide, np.repeat(at_b, cells) + cell % wide
            fits = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
            yield i[fits], j[fits]
        if leaf.all():
            return
        a0, a1, b0, b1, apart = (x[~leaf] for x in (a0, a1, b0, b1, apart))
        ones = np.r_[0, np.cumsum((keys >> np.uint64(BITS - 1 - level)) & np.uint64(1), dtype=np.int64)]
        a_mid, b_mid = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        own = (a0 == b0) & (a1 == b1)  # a node with itself: one of its two mixed pairs is enough
        steps = [(a0, a_mid, b0, b_mid, apart), (a_mid, a1, b_mid, b1, apart),
                 (a0, a_mid, b_mid, b1, apart + 1),
                 (a_mid, np.where(own, a_mid, a1), b0, b_mid, apart + 1)]
        a0, a1, b0, b1, apart = (np.concatenate(x) for x in zip(*steps, strict=True))
        alive = (a1 > a0) & (b1 > b0) & (apart <= budget) & ~((a0 == b0) & (a1 == b1) & (a1 - a0 < 2))
        a0, a1, b0, b1, apart = (x[alive] for x in (a0, a1, b0, b1, apart))


def _forest(keys: np.ndarray, starts: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked in each run, one for each member that is not the first of its group."""
    label = np.arange(len(keys))
    for i, j in trie_pairs(keys, starts, depth, budget):
        while len(i):
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            while (label[label] != label).any():
                label = label[label]
            open_ = label[i] != label[j]
            i, j = i[open_], j[open_]
    moved = np.flatnonzero(label != np.arange(len(keys)))
    return moved, label[moved]


def _joined(orders: list[list[tuple[int, int, int]]], depth: int, budget: int):
    """Joins each run of rows of equal ``order, a, b``, as they come sorted with their keys.

    The keys of a run share their first bit, so signed and unsigned order are the same.
    """
    def solved(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        order, key = frame["order"].to_numpy(), frame["key"].to_numpy()
        run = np.flatnonzero(np.r_[True, (order[1:] != order[:-1])
                                   | (frame["a"].to_numpy()[1:] != frame["a"].to_numpy()[:-1])
                                   | (frame["b"].to_numpy()[1:] != frame["b"].to_numpy()[:-1])])
        size = np.diff(np.r_[run, len(frame)])
        some = size > 1
        if not some.any():
            return
        run, size = run[some], size[some]
        chunk = np.cumsum(size.astype(float) ** 2) // _WORK
        for value in np.unique(chunk):
            first, length = run[chunk == value], size[chunk == value]
            offset = np.r_[0, np.cumsum(length)[:-1]]
            rows = np.repeat(first - offset, length) + np.arange(length.sum())
            keys, kinds = key[rows].view(np.uint64), order[rows]
            x, y = _forest(keys, offset, depth, budget)
            for kind in np.unique(kinds[x]):
                mine = kinds[x] == kind
                yield pd.DataFrame({"a": _restored(keys[x[mine]], orders[kind]).view(np.int64),
                                    "b": _restored(keys[y[mine]], orders[kind]).view(np.int64)})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = rows.iloc[-1]
            open_ = ((rows["order"] == last["order"]) & (rows["a"] == last["a"]) & (rows["b"] == last["b"])).to_numpy()
            held = rows[open_]
            yield from solved(rows[~open_])
        if held is not None:
            yield from solved(held)

    return work


def near_prints(
    spark: SparkSession, prints: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS,
) -> DataFrame:
    """Links ``a, b`` that connect all ``print`` values within ``budget`` differing bits of each other.

    ``prints`` holds distinct values. In every order of the bits (see ``bit_orders``) the
    tries' first levels are shared, so they are the shuffle key. Below a shared node, node
    pairs descend together (``trie_pairs``). Nodes of more than ``node_rows`` members are
    first split: their children's pairs within the budget are formed by Spark, level after
    level, until each pair is small enough for a task; nothing is left out.
    """
    n = prints.count()
    blocks = next(b for b, most in BLOCKS_UP_TO if most is None or n <= most)
    orders, depth = bit_orders(blocks, budget)
    value = F.col("print")
    keys = prints.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("order"), _ordered(value, order).alias("key")) for i, order in enumerate(orders)
    ])).alias("k")).select("k.order", "k.key", F.shiftrightunsigned("k.key", BITS - depth).alias("a"))

    counts = keys.groupBy("order", "a").agg(F.count(F.lit(1)).alias("n"))
    large = settle(spark, counts.where(F.col("n") > node_rows).select("order", "a"), "large-nodes")
    crowded = not large.isEmpty()
    small = keys.join(large, ["order", "a"], "left_anti") if crowded else keys
    links = [_scan(small.withColumn("b", F.col("a")), orders, depth, budget)]
    if crowded:
        members = settle(spark, keys.join(large, ["order", "a"]).select("order", "key"), "large-members")
        links += _split(spark, members, large, orders, depth, budget, node_rows)
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return settle(spark, out.distinct(), "links")


def _scan(rows: DataFrame, orders: list, depth: int, budget: int) -> DataFrame:
    rows = rows.select("order", "a", "b", "key").repartition("order", "a", "b")
    rows = rows.sortWithinPartitions("order", "a", "b", "key")
    return rows.mapInPandas(_joined(orders, depth, budget), "a long, b long")


def _split(
    spark: SparkSession, members: DataFrame, large: DataFrame, orders: list, depth: int, budget: int, node_rows: int,
) -> list[DataFrame]:
    """Descends from large nodes by ``STEP`` levels a round; the node pairs that became small are joined."""
    links, level = [], depth
    pairs = large.select("order", "a", F.col("a").alias("b"))
    while not pairs.isEmpty():
        below = min(level + STEP, BITS)
        node, child = (F.shiftrightunsigned("key", BITS - x) if x < BITS else F.col("key") for x in (level, below))
        nodes = members.groupBy("order", node.alias("node"), child.alias("child")).agg(F.count(F.lit(1)).alias("n"))
        nodes = settle(spark, nodes, "nodes")
        one = nodes.select(F.col("order").alias("o1"), F.col("node").alias("x"), F.col("child").alias("c1"),
                           F.col("n").alias("n1"))
        two = nodes.select(F.col("order").alias("o2"), F.col("node").alias("y"), F.col("child").alias("c2"),
                           F.col("n").alias("n2"))
        # Names of nodes hold all bits above them, so this is what has added up on the way down.
        apart = F.bit_count(F.col("c1").bitwiseXOR(F.col("c2")))
        found = pairs.join(one, (F.col("order") == F.col("o1")) & (F.col("a") == F.col("x")))
        found = found.join(two, (F.col("order") == F.col("o2")) & (F.col("b") == F.col("y")) & (apart <= budget)
                           & ((F.col("a") != F.col("b")) | (F.col("c1") <= F.col("c2"))))
        found = settle(spark, found.select(
            "order", F.col("c1").alias("a"), F.col("c2").alias("b"),
            F.when(F.col("c1") == F.col("c2"), F.col("n1")).otherwise(F.col("n1") + F.col("n2")).alias("n")), "pairs")
        fits = found.where((F.col("n") <= node_rows) & (F.col("n") > 1)).select("order", "a", "b")
        fits = fits.withColumnRenamed("order", "o")
        rows = members.withColumn("child", child)
        sides = rows.join(fits, (F.col("order") == F.col("o")) & (F.col("child") == F.col("a")))
        other = rows.join(fits.where("a <> b"), (F.col("order") == F.col("o")) & (F.col("child") == F.col("b")))
        # The members of a pair share the levels above the large node it comes from.
        links.append(settle(spark, _scan(sides.select("order", "a", "b", "key").union(
            other.select("order", "a", "b", "key")), orders, depth, budget), "split-links"))
        pairs = found.where(F.col("n") > node_rows).select("order", "a", "b")
        level = below
    return links


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = SHINGLE_WORDS, budget: int = BUDGET, node_rows: int = NODE_ROWS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    Words are runs without ASCII white space, A-Z in lower case; the shingles of
    ``words`` words count with repeats, fewer words are one shingle. Fingerprints that differ
    in at most ``budget`` bits are linked, equal ones too; ``component_id`` is the smallest id
    reachable over links.

    Null, empty and blank texts have the fingerprint zero, linked like any other. Repeated rows and
    ids are documents of their own. A null id counts as larger than any other; a component of null
    ids alone has the null id. Other columns are ignored. An empty table gives an empty result.
    """
    feats = settle(spark, fingerprints(docs, id_col, text_col, words), "prints")
    nodes = settle(spark, feats.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    labels = components(spark, near_prints(spark, nodes.select("print"), budget, node_rows))
    labels = labels.select(F.col("node").alias("print"), "root")
    named = nodes.join(labels, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("print", "component_id")
    out = feats.join(named, "print", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
