"""Ranked lexical search over bit-sliced Bloom signatures: upper bounds first, exact scores for what they leave."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import ROW, mix, settle, with_row_keys

#: Results per item.
TOP = 10
#: Occurrences from which a term is entered once more, so that a signature also bounds how often it occurs.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512, 1024, 4096])
#: Signature bits for each entered key, bits that a key sets, the smallest and the largest signature. A fuller
#: signature than these bits allow only raises bounds: such a document is scored exactly.
BITS_PER_KEY, HASHES, LEAST_BITS, MOST_BITS = 12, 4, 256, 1 << 22
#: Documents of a block at most, and bits of a block (slices times documents) at most.
BLOCK_DOCS, BLOCK_BITS = 1024, 1 << 24
#: Documents an item that are scored for its first threshold, in multiples of the results.
FIRST = 4
#: Bytes of item texts that are searched in one pass; more items take more passes.
PASS_BYTES = 1 << 20
#: Candidate rows that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 100_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TERM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_low:_high + 1] = False
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_CODES[~_TERM] = 0
_STEPS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_LEVEL_CODES = mix(np.arange(1, len(LEVELS) + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
#: The most occurrences of a term whose highest level is the given one (0: none); the last has no bound.
_MOST = np.array([0, *[x - 1 for x in LEVELS[1:]], np.iinfo(np.int32).max], dtype=np.int64)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]), 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def term_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each term, in order: runs of ASCII letters, digits and other characters beyond ASCII."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    inside = _TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(data))
    return mix(np.add.reduceat(_CODES[data] * up[:len(data)], starts) * down[starts])


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a text as sorted hashes, and how often each occurs."""
    return np.unique(term_hashes(text), return_counts=True)


# ---- scores ----------------------------------------------------------------------------------


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """The part of a document's length in its scores."""
    return 100 - 90 + (90 * n * n_docs) // max(total, 1)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one term adds per weight; it grows with ``tf``."""
    return (1_000_000_000 * tf) // np.maximum(1000 * tf + 8 * m, 1)


@dataclass
class Items:
    """The items of one pass: the sorted terms of all, and each item's places and weights among them."""

    keys: list[int]
    terms: np.ndarray
    places: list[np.ndarray]
    weights: np.ndarray | None = None
    n_docs: int = 0
    total: int = 0

    @staticmethod
    def of(rows: list[tuple[int, str | None]]) -> Items:
        sets = [term_counts(text)[0] for _, text in rows]
        terms = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]))
        return Items([key for key, _ in rows], terms, [np.searchsorted(terms, s) for s in sets])

    def found(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted ``terms`` are item terms: their positions, and their places among the item terms."""
        at = np.searchsorted(self.terms, terms)
        hit = np.flatnonzero(at < len(self.terms))
        hit = hit[self.terms[at[hit]] == terms[hit]]
        return hit, at[hit]


# ---- the index ---------------------------------------------------------------------------------


def bloom_places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits (a power of two in all) that each key sets, one row a hash function."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    return ((keys[None, :] * _STEPS[:, None]) >> shift).astype(np.int64)


def entered_keys(terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One key for each term and level that its occurrences reach."""
    reach = np.searchsorted(LEVELS, counts, side="right")
    place = np.repeat(np.arange(len(terms)), reach)
    level = np.arange(len(place)) - np.repeat(np.cumsum(reach) - reach, reach)
    return mix(terms[place] + _LEVEL_CODES[level])


BLOCKS = pa.schema([
    ("bits", pa.int32()), ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int64())), ("slices", pa.binary()), ("term", pa.int64()), ("df", pa.int64()),
])
_BLOCKS_DDL = ("bits int, ids array<long>, hashes array<long>, sizes array<long>, slices binary, "
               "term long, df long")


def _block(bits: int, rows: list[tuple]) -> pa.RecordBatch:
    """Signatures of documents as slices: for each bit of a signature, which documents set it."""
    grid = np.zeros((bits, -(-len(rows) // 8) * 8), dtype=bool)
    for i, (_, _, _, keys) in enumerate(rows):
        grid[bloom_places(keys, bits).ravel(), i] = True
    columns = [[bits], [[r[0] for r in rows]], [[r[1] for r in rows]], [[r[2] for r in rows]],
               [np.packbits(grid, axis=1).tobytes()], [None], [None]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, BLOCKS.types, strict=True)],
                                      schema=BLOCKS)


def _indexer(items: Items, build: bool):
    """Blocks of signatures, and for each partition how many of its documents hold each item term."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(items.terms), dtype=np.int64)
        open_: dict[int, list[tuple]] = {}
        for batch in batches:
            for doc, text, key in zip(*[batch.column(c).to_pylist() for c in ("id", "text", "hash")], strict=True):
                terms, counts = term_counts(text)
                if not len(terms):
                    continue
                df[items.found(terms)[1]] += 1
                if not build:
                    continue
                keys = entered_keys(terms, counts)
                bits = min(max(LEAST_BITS, 1 << (BITS_PER_KEY * len(keys) - 1).bit_length()), MOST_BITS)
                rows = open_.setdefault(bits, [])
                rows.append((doc, key, int(counts.sum()), keys))
                if len(rows) >= BLOCK_DOCS or len(rows) * bits >= BLOCK_BITS:
                    yield _block(bits, open_.pop(bits))
        for bits, rows in open_.items():
            yield _block(bits, rows)
        some = np.flatnonzero(df)
        none = [pa.nulls(len(some), t) for t in BLOCKS.types[:5]]
        yield pa.RecordBatch.from_arrays([*none, pa.array(items.terms[some].view(np.int64)), pa.array(df[some])],
                                         schema=BLOCKS)

    return work


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("hash"))


# ---- the search --------------------------------------------------------------------------------


def upper_bounds(items: Items, bits: int, sizes: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """For each item and document of a block, a number that its score cannot exceed.

    A term is present where all slices of its key are set, at most as often as its highest
    present level allows. Weights times the gains of these counts are summed slice by slice.
    """
    docs = len(sizes)
    level = np.zeros((len(items.terms), docs), dtype=np.uint8)
    rows, mask = np.arange(len(items.terms)), None
    for code in _LEVEL_CODES:
        places = bloom_places(mix(items.terms[rows] + code), bits)
        found = slices[places[0]]
        for place in places[1:]:
            found &= slices[place]
        mask = found if mask is None else mask & found
        some = mask.any(axis=1)
        rows, mask = rows[some], mask[some]
        if not len(rows):
            break
        level[rows] += np.unpackbits(mask, axis=1, count=docs)
    m = length_part(sizes, items.n_docs, items.total)
    table = np.stack([gain(np.minimum(most, sizes), m) for most in _MOST])
    out = np.zeros((len(items.keys), docs), dtype=np.int64)
    every = np.arange(docs)
    for i, places in enumerate(items.places):
        own = items.weights[places]
        for first in range(0, len(places), 256):
            some = places[first:first + 256]
            out[i] += own[first:first + 256] @ table[level[some], every[None, :]]
    return out


FOUND = pa.schema([("item", pa.int64()), ("id", pa.int64()), ("hash", pa.int64()), ("bound", pa.int64())])
_FOUND_DDL = "item long, id long, hash long, bound long"


def _searcher(items: Items, least: dict[int, int] | None, top: int):
    """Documents by upper bounds: each item's ``top`` of the partition, or all that reach its ``least`` bound."""
    floors = None if least is None else np.array([least.get(k, 1) for k in items.keys], dtype=np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items.keys]
        for batch in batches:
            for bits, ids, hashes, sizes, slices in zip(*[batch.column(c) for c in range(5)], strict=True):
                ids, hashes = ids.as_py(), hashes.as_py()
                sizes = np.array(sizes.as_py(), dtype=np.int64)
                grid = np.frombuffer(slices.as_buffer(), dtype=np.uint8).reshape(bits.as_py(), -1)
                bound = upper_bounds(items, bits.as_py(), sizes, grid)
                if floors is not None:
                    i, j = np.nonzero(bound >= floors[:, None])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([items.keys[x] for x in i], pa.int64()), pa.array([ids[x] for x in j], pa.int64()),
                        pa.array([hashes[x] for x in j], pa.int64()), pa.array(bound[i, j])], schema=FOUND)
                    continue
                for i, row in enumerate(bound):
                    floor = best[i][-1][0] if len(best[i]) == top else 0
                    if row.max() > floor:
                        fresh = [(int(row[j]), hashes[j], ids[j]) for j in np.flatnonzero(row > floor)]
                        best[i] = sorted(set(best[i] + fresh), key=lambda x: (-x[0], x[1]))[:top]
        if floors is None:
            rows = [(key, doc, text, bound) for key, own in zip(items.keys, best, strict=True)
                    for bound, text, doc in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], schema=FOUND)

    return work


SCORED = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_SCORED_DDL = "item long, doc_id long, score long"


def _scorer(items: Items, top: int):
    """Exact scores of whole texts for the items they are candidates of; the best of each partition stay."""
    index = {key: i for i, key in enumerate(items.keys)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for doc, text, wanted in zip(*[batch.column(c).to_pylist() for c in ("id", "text", "items")], strict=True):
                terms, counts = term_counts(text)
                m = length_part(np.array(counts.sum()), items.n_docs, items.total)
                hit, place = items.found(terms)
                gains = np.zeros(len(items.terms), dtype=np.int64)
                gains[place] = gain(counts[hit], m)
                for key in wanted:
                    own = items.places[index[key]]
                    score = int(items.weights[own] @ gains[own])
                    if score > 0:
                        rows = best.setdefault(key, [])
                        rows.append((-score, doc is None, doc))
                        if len(rows) >= 8 * top:
                            best[key] = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:top]
        rows = [(key, r[2], -r[0]) for key, own in best.items()
                for r in sorted(own, key=lambda r: (r[0], r[1], r[2] or 0))[:top]]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], schema=SCORED)

    return work


def _scored(spark: SparkSession, docs: DataFrame, found: DataFrame, items: Items, top: int) -> DataFrame:
    """Exact scores of the candidates ``found``, each text read once for all its items."""
    wanted = found.groupBy("id", "hash").agg(F.collect_set("item").alias("items"))
    wanted = settle(spark, wanted.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), "items"), "wanted")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    side = F.broadcast(wanted) if few else wanted
    rows = docs.join(side, (F.col("hash") == F.col("__hash")) & F.col("id").eqNullSafe(F.col("__id")))
    return rows.select("id", "text", "items").mapInArrow(_scorer(items, top), _SCORED_DDL)


def _best(rows: DataFrame, order: list, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return rows.withColumn("rank", place).where(F.col("rank") <= top)


def search(
    spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", top: int = TOP, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each row of ``items`` by score.

    A score sums, over the item's distinct terms, weight times gain, all in integers (see
    ``term_weight``, ``length_part``, ``gain``). Documents are read once into blocks of like
    length: a Bloom signature each, stored slice by slice. One pass over the blocks takes the
    documents with the highest upper bounds and scores them exactly; the ``top``-th of these scores
    is what a document must reach. A second pass takes every document whose bound reaches it, and
    these are scored exactly, so no document is excluded without proof.

    Terms are compared by 64-bit hashes. Null and empty texts hold no term: as documents they do not
    count, as items they have no row. Repeated rows are documents (or items) of their own, equal scores go by
    ascending id, a null id last. Items are searched in passes of about ``pass_bytes`` of text,
    so what is sent to tasks stays bounded. Other columns are ignored. Without documents or items the
    result is empty.
    """
    asked = with_row_keys(spark, items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("__text")))
    size = asked.agg(F.sum(F.octet_length("__text")).alias("n")).first()["n"] or 0
    passes = max(1, -(-size // pass_bytes))
    texts = _keyed(docs, id_col, text_col)
    blocks, out = None, None
    for i in range(passes):
        own = asked.where(F.pmod(F.xxhash64(ROW), F.lit(passes)) == i).select(ROW, "__text").orderBy(ROW)
        part = Items.of([tuple(r) for r in own.collect()])  # at most about pass_bytes of text
        scan = texts.mapInArrow(_indexer(part, blocks is None), _BLOCKS_DDL)
        scan = settle(spark, scan, "signatures")
        if blocks is None:
            blocks = scan.where("bits is not null").select("bits", "ids", "hashes", "sizes", "slices")
            sizes = blocks.select(F.size("ids").alias("docs"), F.aggregate("sizes", F.lit(0).cast("long"),
                                                                          lambda a, x: a + x).alias("terms"))
            totals = sizes.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
        part.n_docs, part.total = totals["docs"] or 0, totals["terms"] or 0
        df = dict.fromkeys(part.terms.view(np.int64).tolist(), 0)
        df.update(scan.where("term is not null").groupBy("term").agg(F.sum("df")).collect())  # one row an item term
        part.weights = np.array([term_weight(part.n_docs, x) for x in df.values()], dtype=np.int64)

        first = blocks.mapInArrow(_searcher(part, None, FIRST * top), _FOUND_DDL)
        first = _best(first, [F.desc("bound"), "hash", "id"], FIRST * top)
        scores = _best(_scored(spark, texts, first, part, top), [F.desc("score"), F.asc_nulls_last("doc_id")], top)
        least = {r["item"]: r["score"] for r in scores.where(F.col("rank") == top).select("item", "score").collect()}
        found = settle(spark, blocks.mapInArrow(_searcher(part, least, top), _FOUND_DDL), "candidates")
        best = _best(_scored(spark, texts, found, part, top), [F.desc("score"), F.asc_nulls_last("doc_id")], top)
        out = best if out is None else out.union(best)
    named = asked.select(F.col(ROW).alias("item"), "item_id")
    return out.join(named, "item").select("item_id", "rank", "doc_id", "score")
