"""Document fingerprints by Order MinHash: minimal numbered k-mers, kept in text order, hashed as tuples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import mix

#: Code points of a k-mer, k-mers of a tuple, tuples of a fingerprint.
K, PICKS, TUPLES = 8, 2, 48
#: Ranges of ids for each shuffle partition when neighbours are looked up.
RANGES = 8

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 1 << 18


def _seeds(count: int) -> np.ndarray:
    mixed = mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return (mixed >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def order_minhash(text: str | None, k: int = K, picks: int = PICKS, tuples: int = TUPLES) -> str:
    """``tuples`` hashes of 8 hex digits each; equal texts have equal fingerprints.

    Repeated k-mers are numbered by occurrence. Each of the hash functions picks the
    numbered k-mers with the smallest values; their k-mers, in text order, make a tuple,
    so an edit changes a tuple only if it changes or reorders what was picked. Texts
    shorter than ``k`` are one k-mer; null and empty texts have all zeros.
    """
    if not text:
        return "0" * (8 * tuples)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    width = min(k, len(codes))
    n = len(codes) - width + 1
    kmers = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        kmers = kmers * _BASE + codes[i:i + n]
    kmers = mix(kmers)

    # Occurrence numbers: sort hashes with positions in the low bits, then count inside equal hashes.
    bits = np.uint64(max(1, (n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    at = np.arange(n, dtype=np.uint64)
    order = np.sort((kmers & ~low) | at)
    high, place = order >> bits, (order & low).astype(np.int64)
    fresh = np.r_[True, high[1:] != high[:-1]]
    number = np.empty(n, dtype=np.uint64)
    number[place] = at - np.maximum.accumulate(np.where(fresh, at, np.uint64(0)))
    numbered = mix(kmers + number * np.uint64(0xD6E8FEB86659FD93))

    take = min(picks, n)
    # Products of 32 bits order the k-mers; equal products go by position.
    seeds = _seeds(tuples)
    numbered = (numbered >> np.uint64(32)).astype(np.uint32)
    step = max(1, _CELLS // n)
    chosen = np.empty((tuples, take), dtype=np.int64)
    for first in range(0, tuples, step):
        values = numbered[None, :] * seeds[first:first + step, None]
        if n <= 64:
            best = np.argsort(values, axis=1, kind="stable")[:, :take]
        else:
            # Only values below a bound are sorted; the bound is doubled until every row has enough.
            bound = 2**32 // n * (take + 10)
            while True:
                cells = np.flatnonzero(values < np.uint32(min(bound, 2**32 - 1)))
                rows = cells // n
                counts = np.bincount(rows, minlength=len(values))
                if counts.min() >= take:
                    break
                bound *= 2  # at the largest bound only the largest value is left out
            cells = cells[np.lexsort((values.ravel()[cells], rows))]
            starts = np.r_[0, np.cumsum(counts)[:-1]]
            best = cells[starts[:, None] + np.arange(take)[None, :]] % n
        chosen[first:first + step] = np.sort(best, axis=1)
    out = np.zeros(tuples, dtype=np.uint64)
    for i in range(take):
        out = mix(out * _BASE + kmers[chosen[:, i]])
    return (out >> np.uint64(32)).astype(">u4").tobytes().hex()


def likeness(one: str, other: str) -> float:
    """Share of equal tuples of two fingerprints."""
    a, b = (np.frombuffer(bytes.fromhex(x), dtype=np.uint32) for x in (one, other))
    return float((a == b).mean()) if len(a) else 1.0


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = K, picks: int = PICKS,
                 tuples: int = TUPLES) -> DataFrame:
    """``docs`` with the ``fingerprint`` of each whole text, computed where it is read."""
    @F.pandas_udf("string")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([order_minhash(text, k, picks, tuples) for text in texts.tolist()], dtype=object)

    return docs.withColumn("fingerprint", fingerprint(F.col(text_col)))


def with_next(
    df: DataFrame, columns: list[str], key: str = "doc_id", prepared: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by descending ``key``; after the last comes the first.

    Keys are cut into like ranges, ``RANGES`` for each shuffle partition, by approximate
    quantiles. Each range is sorted by itself, with a copy of the first row of the
    following range at its end, so no task sees more than some ranges. Equal keys follow
    each other by ``columns``; a null key comes last. The bounds and one first key per
    range reach the driver. ``prepared`` adds columns to rows and copies before they move.
    """
    order = F.coalesce(F.col(key), F.lit(-(2**63)))
    keys = df.select(order.alias("__key"))
    ranges = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / ranges for i in range(1, ranges)]
    bounds = keys.agg(F.percentile_approx("__key", probs, max(10_000, 10 * ranges)).alias("b")).first()["b"] or [0]
    splits = [float("-inf"), *sorted({float(b) for b in bounds}), float("inf")]
    # Rounding to double keeps the order, and equal doubles share a range.
    cut = Bucketizer(splits=splits, inputCol="__point", outputCol="__range")

    def ranged(frame: DataFrame) -> DataFrame:
        return cut.transform(frame.withColumn("__point", F.col("__key").cast("double"))).drop("__point")

    firsts = ranged(keys).groupBy("__range").agg(F.max("__key").alias("first")).orderBy(F.desc("__range")).collect()
    rows = ranged(df.withColumn("__key", order)).withColumn("__copy", F.lit(0))
    if firsts:
        follows = [(firsts[i - 1]["__range"], row["first"]) for i, row in enumerate(firsts)]
        spark = df.sparkSession
        small = F.broadcast(spark.createDataFrame(follows, "__to double, __first long"))
        copies = df.withColumn("__key", order).join(small, F.col("__key") == F.col("__first"))
        copies = copies.withColumns({"__range": F.col("__to"), "__copy": F.lit(1)}).select(rows.columns)
        rows = rows.union(copies)
    if prepared:
        rows = prepared(rows)
    window = Window.partitionBy("__range").orderBy("__copy", F.desc("__key"), *[F.asc(c) for c in columns])
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    return rows.where("__copy = 0").drop("__key", "__range", "__copy")


def edit_likeness(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text of a document has its last third (code points, rounded down) replaced
    by the first as many code points, or all, of the next document by descending id.
    Texts move in one shuffle. Null texts count as empty and all their likenesses compare zeros. Repeated rows
    are documents of their own, an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(texts, ["text", "fingerprint"], prepared=fingerprints)
    size = F.length("text").cast("long")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.length("text") - third)),
                      F.substring(F.col("next_text"), F.lit(1), third))

    @F.pandas_udf("edited_fingerprint string, near_edited double, near_next double")
    def compared(own: pd.Series, following: pd.Series, changed: pd.Series) -> pd.DataFrame:
        prints = [order_minhash(text) for text in changed]
        return pd.DataFrame({
            "edited_fingerprint": prints,
            "near_edited": [likeness(a, b) for a, b in zip(own, prints, strict=True)],
            "near_next": [likeness(a, b) for a, b in zip(own, following, strict=True)]})

    rows = rows.select("doc_id", size.alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited"))
    rows = rows.withColumn("c", compared("fingerprint", "next_fingerprint", "edited"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "c.edited_fingerprint", "c.near_edited", "c.near_next")
