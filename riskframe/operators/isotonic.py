"""Isotonic regression by score ranges: pools inside ranges, then only what violates at their boundaries is merged."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.local import local_table
from riskframe.session import written

#: A block: its first and last score, the mean of its labels and their weight.
BLOCK = "lo double, hi double, y double, w double"


def pool(rows: Iterable[tuple[float, float, float, float]], blocks: list[list[float]] | None = None) -> list[list[float]]:
    """Pools adjacent violators: ``rows`` (lo, hi, y, w) in order of their scores behind ``blocks``, pooled so far."""
    blocks = [] if blocks is None else blocks
    for lo, hi, y, w in rows:
        while blocks and blocks[-1][2] >= y:
            first, _, mean, weight = blocks.pop()
            lo, y, w = first, (mean * weight + y * w) / (weight + w), weight + w
        blocks.append([lo, hi, y, w])
    return blocks


def _columns(frame: pd.DataFrame) -> Iterable[tuple[float, float, float, float]]:
    return zip(*[frame[c].tolist() for c in ("lo", "hi", "y", "w")], strict=True)


def _frame(part: int, blocks: list[list[float]]) -> pd.DataFrame:
    out = pd.DataFrame(blocks, columns=["lo", "hi", "y", "w"], dtype=float)
    out.insert(0, "part", part)
    return out


def _pooled_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pools a sorted range as it comes."""
    blocks, part = [], 0
    for batch in batches:
        part = int(batch["part"].iloc[0]) if len(batch) else part
        pool(_columns(batch), blocks)
    yield _frame(part, blocks)


def boundary_pairs(ends: list[tuple[int, float, float]]) -> list[tuple[int, int, float, float]]:
    """Neighbouring ranges that violate the order, no range twice: (left, right, right's least, left's greatest mean).

    ``ends`` has each range with the means of its first and last block, in order.
    """
    pairs, taken = [], False
    for (left, _, last), (right, first, _) in zip(ends, ends[1:], strict=False):
        taken = not taken and last >= first
        if taken:
            pairs.append((left, right, first, last))
    return pairs


def pooled_blocks(summed: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, lo, hi, y, w): the isotonic fit of (score, y, w), one row per block.

    Scores are distinct. Each range of scores is pooled by itself. Two neighbouring ranges whose means do
    not rise are then merged at their boundary: of the left one only blocks with a mean of at least the right
    one's first, of the right one only blocks of at most the left one's last can change, so only they
    move. Pairs of ranges are merged side by side, round after round, until no boundary violates. The driver sees two
    means per range.
    """
    spark = summed.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = summed.select(F.col("score").alias("lo"), F.col("score").alias("hi"), "y", "w")
    rows = rows.repartitionByRange(parts, "lo").sortWithinPartitions("lo").withColumn("part", F.spark_partition_id())
    blocks = written(rows.select("part", "lo", "hi", "y", "w").mapInPandas(_pooled_part, f"part int, {BLOCK}"), "blocks")
    while True:
        ends = blocks.groupBy("part").agg(F.min("y").alias("first"), F.max("y").alias("last")).orderBy("part").collect()
        pairs = boundary_pairs([(r["part"], r["first"], r["last"]) for r in ends])
        if not pairs:
            return blocks
        sides = [(left, left, first, float("inf")) for left, _, first, _ in pairs]
        sides += [(right, left, float("-inf"), last) for left, right, _, last in pairs]
        # At most one row per range.
        side = F.broadcast(local_table(spark, sides, "__part int, pair int, least double, most double"))
        placed = blocks.join(side, F.col("part") == F.col("__part"), "left")
        inside = F.col("pair").isNotNull() & F.col("y").between(F.col("least"), F.col("most"))
        moved = placed.where(inside).select("pair", "lo", "hi", "y", "w").groupBy("pair").applyInPandas(
            _merged, f"part int, {BLOCK}")
        blocks = written(placed.where(~inside).select("part", "lo", "hi", "y", "w").union(moved), "blocks")


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    return _frame(int(group["pair"].iloc[0]), pool(_columns(group.sort_values("lo"))))
