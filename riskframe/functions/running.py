"""Running totals along a sort order, without one task that sorts everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def bucket_edges(df: DataFrame, order_col: str, buckets: int | None = None) -> list[float]:
    """Inner edges that cut ``df`` into buckets of like size, as many as there are shuffle partitions."""
    buckets = max(2, buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probs = [i / buckets for i in range(1, buckets)]
    # The rank error of the sketch stays well below a bucket.
    accuracy = max(10_000, 10 * buckets)
    edges = df.agg(F.percentile_approx(order_col, probs, accuracy).alias("e")).first()["e"] or []
    return sorted(set(edges))


def running_totals(
    df: DataFrame,
    order_col: str,
    values: Sequence[str],
    group_cols: Sequence[str] = (),
    edges: Sequence[float] = (),
    lead: bool = False,
) -> DataFrame:
    """Adds ``<value>_before``: the sum of ``value`` over rows that come earlier.

    Rows go by ``order_col`` descending inside each group; ``order_col`` must be
    distinct inside a group. ``edges`` splits the order into buckets: each bucket
    is sorted by a task of its own and gets the total of the buckets before it
    from a table of at most (edges + 1) rows per group. With ``lead`` the values
    of the following row are added as ``<value>_next``.
    """
    groups = list(group_cols)
    descending = F.col(order_col).desc()
    # The bucket is a function of the value, so equal values stay together.
    splits = sorted({float("-inf"), float("inf"), *(edges or [0.0])})
    bucketed = Bucketizer(splits=splits, inputCol=order_col, outputCol="__bucket").transform(df)

    inside = Window.partitionBy(*groups, "__bucket").orderBy(descending)
    out = bucketed.withColumns({
        f"__{v}_in": F.coalesce(F.sum(v).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        for v in values
    })
    if lead:
        out = out.withColumns({f"__{v}_lead": F.lead(v).over(inside) for v in values})

    across = Window.partitionBy(*groups).orderBy(F.col("__bucket").desc())
    totals = bucketed.groupBy(*groups, "__bucket").agg(
        *[F.sum(v).alias(f"__{v}_total") for v in values],
        *([F.max_by(F.struct(*values), order_col).alias("__first")] if lead else []),
    ).withColumns({
        f"__{v}_base": F.coalesce(
            F.sum(f"__{v}_total").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        for v in values
    })
    if lead:
        totals = totals.withColumn("__next_first", F.lead("__first").over(across))
    totals = totals.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__bucket").alias("__b"),
        *[f"__{v}_base" for v in values], *(["__next_first"] if lead else []),
    )
    match = F.col("__bucket") == F.col("__b")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    joined = out.join(totals, match)
    result = [F.col(c) for c in df.columns]
    result += [(F.col(f"__{v}_in") + F.col(f"__{v}_base")).alias(f"{v}_before") for v in values]
    if lead:
        result += [F.coalesce(f"__{v}_lead", F.col(f"__next_first.{v}")).alias(f"{v}_next")
                   for v in values]
    return joined.select(*result)
