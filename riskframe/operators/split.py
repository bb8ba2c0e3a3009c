"""Projection, exact splits, folds and samples.

Rows are ordered by a hash of the row key and a seed. A part is a range of that
order, so a part is found from a few cut rows per class: one histogram over hash
prefixes, one ranking of the rows around each cut, and then a plain comparison
per row. The wide rows are never shuffled, sizes are exact, and the result does
not depend on how the input is partitioned. Keys and hashes are held meanwhile, so
the input is read once to find the cuts.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.errors import AmbiguousKeyError
from riskframe.functions.columns import kept, order_hash, quoted

logger = logging.getLogger(__name__)

# Hash digits that one histogram round adds, and the rows of a cut's bucket that are ranked;
# a fuller bucket gets another round.
PREFIX_DIGITS = 4
RANKED_ROWS = 1_000_000
HASH_DIGITS = 32
# Classes that a split keeps balanced, unless told otherwise.
MAX_STRATA = 20


def feature_projection(df: DataFrame, target: str, excluded: Sequence[str] = ()) -> DataFrame:
    """Features plus the target as ``label``; exclusions that do not exist are ignored."""
    if target not in df.columns:
        raise KeyError(f"no target column {target!r}")
    gone = [c for c in excluded if c in df.columns and c != target]
    return df.drop(*gone).withColumnRenamed(target, "label")


@contextmanager
def ordered_rows(df: DataFrame, label: str | None, keys: Sequence[str], seed: int) -> Iterator[DataFrame]:
    """(stratum, hash, key) of each row, held while a split is found: the input is read once for all of its passes."""
    if not keys:
        raise AmbiguousKeyError("a row key is needed")
    with kept(df.select(
            _stratum(label).alias("stratum"), order_hash(keys, seed).alias("hash"),
            F.struct(*[F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"))) as rows:
        yield rows


def class_counts(rows: DataFrame, keys: Sequence[str], limit: int | None = None) -> dict[Any, int]:
    """Ordered rows per class, in class order; a missing label is a class of its own.

    Raises if two rows share a key, wherever they lie. With ``limit`` at most so many classes are counted.
    """
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("stratum").alias("c")).groupBy("c").agg(
        F.sum("n").alias("n"), F.max("n").alias("copies"))
    if limit is not None:
        # Ordered by copies, so that a repeated key is seen whatever the limit leaves out.
        groups = groups.orderBy(F.desc("copies")).limit(limit)
    found = groups.collect()
    if any(r["copies"] > 1 for r in found):
        raise AmbiguousKeyError(f"the key {list(keys)} repeats; it must identify rows")
    return {r["c"]: r["n"] for r in sorted(found, key=lambda r: (r["c"] is not None, r["c"]))}


def largest_remainder(counts: dict[Any, int], draw: int) -> dict[Any, int]:
    """Shares of ``draw`` in proportion to ``counts``; ties go to the first class."""
    total = sum(counts.values())
    exact = {c: draw * n / total for c, n in counts.items()}
    share = {c: math.floor(x) for c, x in exact.items()}
    short = draw - sum(share.values())
    by_rest = sorted(counts, key=lambda c: share[c] - exact[c])
    for c in by_rest[:short]:
        share[c] += 1
    return share


def _stratum(label: str | None) -> Column:
    return F.col(quoted(label)) if label else F.lit(0)


def _starts(prefix: str) -> Column:
    return F.startswith(F.col("hash"), F.lit(prefix))


def _in_bucket(stratum: Any, prefix: str) -> Column:
    return F.col("stratum").eqNullSafe(F.lit(stratum)) & _starts(prefix)


def _any(conditions: Sequence[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def _cut_rows(base: DataFrame, ranks: dict[Any, list[int]], ranked_rows: int) -> dict[tuple[Any, int], tuple]:
    """The order values of the rows at the given 1-based ranks of each class.

    A histogram over hash prefixes finds the bucket of each cut. Prefixes grow until the
    bucket holds few enough rows to be ranked, so no task ranks more than that.
    """
    place = {(c, r): ("", r) for c, wanted in ranks.items() for r in wanted}
    digits, full = 0, {(c, "") for c, _ in place}
    while full and digits < HASH_DIGITS:
        # At most 16^4 rows per bucket that is split.
        inside = base.where(_any([_in_bucket(c, p) for c, p in full])) if digits else base
        parent, digits = F.substring("hash", 1, digits), digits + PREFIX_DIGITS
        histogram = inside.groupBy("stratum", parent.alias("parent"), F.substring("hash", 1, digits).alias("prefix"))
        histogram = histogram.agg(F.count(F.lit(1)).alias("n")).withColumn(
            "upto", F.sum("n").over(Window.partitionBy("stratum", "parent").orderBy("prefix")))
        cuts = {key: at for key, at in place.items() if (key[0], at[0]) in full}
        hits = histogram.where(_any([
            F.col("stratum").eqNullSafe(F.lit(c)) & (F.col("parent") == p) & (F.col("upto") >= r)
            & (F.col("upto") - F.col("n") < r) for (c, _), (p, r) in cuts.items()]))
        full = set()
        for row in hits.collect():
            for key, (p, r) in cuts.items():
                before = row["upto"] - row["n"]
                if (key[0], p) == (row["stratum"], row["parent"]) and before < r <= row["upto"]:
                    place[key] = (row["prefix"], r - before)
                    if row["n"] > ranked_rows:
                        full.add((row["stratum"], row["prefix"]))

    prefix = F.lit(None).cast("string")
    for c, p in {(c, p) for (c, _), (p, _) in place.items()}:
        prefix = F.when(_in_bucket(c, p), F.lit(p)).otherwise(prefix)
    order = Window.partitionBy("stratum", "prefix").orderBy("hash", "key")
    ranked = base.withColumn("prefix", prefix).where("prefix is not null").select(
        "stratum", "prefix", "hash", "key", F.row_number().over(order).alias("rank"))
    wanted = _any([F.col("stratum").eqNullSafe(F.lit(c)) & (F.col("prefix") == p) & (F.col("rank") == inner)
                   for (c, _), (p, inner) in place.items()])
    found = {}
    for row in ranked.where(wanted).collect():
        for (c, r), (p, inner) in place.items():
            if (c, p, inner) == (row["stratum"], row["prefix"], row["rank"]):
                found[c, r] = (row["hash"], tuple(row["key"]))
    return found


def range_index(
    df: DataFrame, rows: DataFrame, label: str | None, keys: Sequence[str], seed: int,
    counts: dict[Any, int], sizes: dict[Any, list[int]], ranked_rows: int = RANKED_ROWS,
) -> Column:
    """Index of the range a row of ``df`` falls in when each class is cut into ``sizes`` along the order.

    The last range of a class takes the rows after all cuts. ``rows`` are the ordered rows of ``df``.
    """
    bounds = {}
    for c, parts in sizes.items():
        ends, total = [], 0
        for size in parts[:-1]:
            total += size
            ends.append(total)
        bounds[c] = ends
    ranks = {c: sorted({e for e in ends if 0 < e < counts[c]}) for c, ends in bounds.items()}
    cuts = {}
    if any(ranks.values()):
        cuts = _cut_rows(rows, ranks, ranked_rows)

    here = order_hash(keys, seed)
    key = F.struct(*[F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(keys)])
    types = [df.schema[k].dataType for k in keys]
    index: Column | None = None
    for c, ends in bounds.items():
        position = F.lit(0)
        for end in ends:
            if end <= 0:
                past = F.lit(1)
            elif end >= counts[c]:
                past = F.lit(0)
            else:
                cut_hash, cut_key = cuts[c, end]
                same = F.struct(*[F.lit(v).cast(t).alias(f"k{i}")
                                  for i, (v, t) in enumerate(zip(cut_key, types))])
                past = ((here > cut_hash) | ((here == cut_hash) & (key > same))).cast("int")
            position = position + past
        match = _stratum(label).eqNullSafe(F.lit(c))
        index = F.when(match, position) if index is None else index.when(match, position)
    return index if index is not None else F.lit(0)


def assign_parts(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    test_size: float = 0.2,
    validation_size: float = 0.0,
    seed: int = 42,
    stratify: bool = True,
    ranked_rows: int = RANKED_ROWS,
    max_strata: int = MAX_STRATA,
) -> DataFrame:
    """Adds ``part``: test, validation (if asked for) or train.

    The test part has ceil(test_size x n) rows. With strata, class sizes follow
    the largest remainder of the rows that stay. A target of more than ``max_strata``
    values is not stratified.
    """
    with ordered_rows(df, label if stratify else None, keys, seed) as rows:
        # A few more classes than allowed are enough to see that there are too many.
        counts = class_counts(rows, keys, max_strata + 2)
        distinct = len([c for c in counts if c is not None])
        strata = label if stratify and 1 < distinct <= max_strata else None
        if stratify and not strata:
            logger.warning("the target has %s unique values; the split is not stratified",
                           distinct if distinct <= max_strata else f"more than {max_strata}")
        if not strata:
            rows, counts = rows.withColumn("stratum", F.lit(0)), {0: rows.count()}

        total = sum(counts.values())
        names = ["test"] + (["validation"] if validation_size else [])
        sizes: dict[Any, list[int]] = {c: [] for c in counts}
        left = dict(counts)
        for fraction in [test_size] + ([validation_size] if validation_size else []):
            drawn = math.ceil(fraction * total - 1e-9)
            stay = largest_remainder(left, sum(left.values()) - drawn)
            for c in counts:
                sizes[c].append(left[c] - stay[c])
            left = stay
        for c in counts:
            sizes[c].append(left[c])
        index = range_index(df, rows, strata, keys, seed, counts, sizes, ranked_rows)
    labels = F.array(*[F.lit(n) for n in [*names, "train"]])
    return df.withColumn("part", F.element_at(labels, index + 1))


def train_test_split(df: DataFrame, label: str, keys: Sequence[str], test_size: float = 0.2,
                     seed: int = 42, stratify: bool = True) -> tuple[DataFrame, DataFrame]:
    parts = assign_parts(df, label, keys, test_size, seed=seed, stratify=stratify)
    return (parts.where("part = 'train'").drop("part"), parts.where("part = 'test'").drop("part"))


def fold_sizes(counts: dict[Any, int], k: int) -> dict[Any, list[int]]:
    """Rows per class and fold when the class-ordered rows are dealt out in turn."""
    sizes, start = {}, 0
    for c, n in counts.items():
        sizes[c] = [len(range((i - start) % k, n, k)) for i in range(k)]
        start += n
    return sizes


def assign_folds(df: DataFrame, label: str, keys: Sequence[str], k: int = 5, seed: int = 42,
                 ranked_rows: int = RANKED_ROWS, max_classes: int = MAX_STRATA) -> DataFrame:
    """Adds ``fold`` in 0..k-1, with every class spread evenly over the folds.

    A label of more than ``max_classes`` values is refused: it is no class label.
    """
    with ordered_rows(df, label, keys, seed) as rows:
        counts = class_counts(rows, keys, max_classes + 2)
        if len([c for c in counts if c is not None]) > max_classes:
            raise ValueError(f"the column {label!r} has more than {max_classes} classes")
        smallest = min(counts.values(), default=0)
        if max(counts.values(), default=0) < k:
            raise ValueError(f"{k} folds need at least {k} rows in some class")
        if smallest < k:
            logger.warning("the smallest class has %s rows for %s folds", smallest, k)
        index = range_index(df, rows, label, keys, seed, counts, fold_sizes(counts, k), ranked_rows)
    return df.withColumn("fold", index)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42,
                ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), the same for the same key and seed."""
    with ordered_rows(df, None, keys, seed) as rows:
        counts = class_counts(rows, keys)
        total = counts.get(0, 0)
        if total <= n:
            return df
        index = range_index(df, rows, None, keys, seed, counts, {0: [n, total - n]}, ranked_rows)
    return df.where(index == 0)


def part_balance(df: DataFrame, part: str, label: str) -> DataFrame:
    """(part, label, n, share): the class balance of each part."""
    counts = df.groupBy(part, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(part)))
