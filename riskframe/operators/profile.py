"""Profiling tables: numeric and categorical summaries, histograms, correlations."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import nan_to_null, quoted, to_long
from riskframe.functions.local import local_table
from riskframe.functions.quantiles import exact_quantiles, sketched_brackets
from riskframe.operators.quality import missing_counts

QUARTILES = (0.25, 0.5, 0.75)


def overview(df: DataFrame) -> DataFrame:
    """One row per column with its type and position, and the table's size."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    n_rows = df.count()
    return local_table(df.sparkSession, rows, "position int, column string, dtype string").select(
        "position", "column", "dtype",
        F.lit(n_rows).cast("bigint").alias("n_rows"), F.lit(len(rows)).alias("n_columns"))


def numeric_summary(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column.

    Exact quartiles take one more pass over the columns. ``exact=False`` takes
    them from the same pass with a relative rank error of 1/10,000.
    """
    spark = df.sparkSession
    schema = ("column string, n bigint, mean double, std double, min double, "
              "p25 double, p50 double, p75 double, max double")
    if not columns:
        return local_table(spark, [], schema)
    df = nan_to_null(df)
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(quoted(c)).cast("double")
        aggregates += [
            F.count(value).alias(f"n{i}"), F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}"),
        ]
        if not exact:
            aggregates.append(F.percentile_approx(value, list(QUARTILES), 10_000).alias(f"q{i}"))
    if exact:
        aggregates += sketched_brackets(columns, QUARTILES)
    row = df.agg(*aggregates).first()
    if exact:
        counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
        quartiles = exact_quantiles(df, columns, QUARTILES, counts,
                                    around={c: row[f"__kll{i}"] for i, c in enumerate(columns)})
    else:
        quartiles = {c: row[f"q{i}"] or [None] * 3 for i, c in enumerate(columns)}
    rows = [
        (c, row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], *quartiles[c], row[f"max{i}"])
        for i, c in enumerate(columns)
    ]
    return local_table(spark, rows, schema)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over all columns with one shuffle; NULL is a value."""
    return to_long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value (smallest on ties) and missing count per column."""
    if not columns:
        return local_table(
        df.sparkSession, [], "column string, n_unique bigint, top_value string, top_frequency bigint, n_missing bigint")
    return value_counts(df, columns).groupBy("column").agg(
        F.count("value").alias("n_unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
        F.max("n").alias("top_frequency"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
    )


def category_shares(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """Cardinality and the shares of the most frequent non-missing values per column."""
    counts = value_counts(df, columns).where("value is not null")
    totals = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("filled"))
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # One row per column on the right.
    return ranked.join(F.broadcast(totals), "column").select(
        "column", "n_unique", "rank", "value", "n", (F.col("n") / F.col("filled")).alias("share"))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, worst first."""
    return (
        missing_counts(df).where(F.col("missing_count") > 0)
        .select("column", "missing_count", (F.col("missing_fraction") * 100).alias("missing_percentage"))
        .orderBy(F.col("missing_percentage").desc(), "column")
    )


def linear_edges(low: float, high: float, bins: int) -> list[float]:
    """Edges of equal-width bins; a single point is widened by half a unit to each side."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = 30, max_columns: int | None = None,
) -> DataFrame:
    """(column, bin, lower, upper, n) for equal-width bins over each column's range.

    A value on an edge is in the upper bin, and the last bin is closed. Empty bins
    are kept, missing values are left out.
    """
    columns = list(columns)[:max_columns]
    df = nan_to_null(df)
    bounds = []
    for i, c in enumerate(columns):
        value = F.col(quoted(c)).cast("double")
        bounds += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
    row = df.agg(*bounds).first()
    used = [i for i in range(len(columns)) if row[f"lo{i}"] is not None]
    edges = {i: linear_edges(row[f"lo{i}"], row[f"hi{i}"], bins) for i in used}
    frame = local_table(
        df.sparkSession,
        [(columns[i], b, edges[i][b], edges[i][b + 1]) for i in used for b in range(bins)],
        "column string, bin int, lower double, upper double")
    if not used:
        return frame.withColumn("n", F.lit(0).cast("bigint"))
    values = df.select(*[F.col(quoted(columns[i])).cast("double").alias(f"v{i}") for i in used])
    # Missing values go to one bin more, which the join below has no row for.
    binned = Bucketizer(
        inputCols=[f"v{i}" for i in used], outputCols=[f"b{i}" for i in used],
        splitsArray=[edges[i] for i in used], handleInvalid="keep").transform(values)
    counts = (
        to_long(binned.select(*[F.col(f"b{i}").alias(columns[i]) for i in used]),
                [columns[i] for i in used], as_type="int", value="bin")
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    # Both sides hold at most bins x columns rows.
    return frame.join(F.broadcast(counts), ["column", "bin"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))


#: Columns up to which one aggregation of the JVM holds all pairs, and columns of a block beyond.
PAIRWISE_COLUMNS, BLOCK_COLUMNS = 40, 1024
#: Partial results that are merged in one task.
MERGED = 64


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, correlation), pairwise complete, full matrix, in one scan up to ``BLOCK_COLUMNS`` columns.

    Wide tables take blocked cross products (``cross_products``), a scan for each pair of blocks.
    """
    if len(columns) > PAIRWISE_COLUMNS:
        return wide_correlation(df, columns)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    df = nan_to_null(df)
    value = [F.col(quoted(c)).cast("double") for c in columns]
    result = df.agg(*[F.corr(value[i], value[j]).alias(f"r{k}") for k, (i, j) in enumerate(pairs)]).first()
    rows = []
    for k, (i, j) in enumerate(pairs):
        r = result[f"r{k}"]
        r = None if r is None or math.isnan(r) else r
        rows.append((columns[i], columns[j], r))
        if i != j:
            rows.append((columns[j], columns[i], r))
    return local_table(df.sparkSession, rows, "column_a string, column_b string, correlation double")


#: Of each pair of columns, over the rows that have both: their number, the two means, the sums of squared deviations
#: and the sum of products of deviations.
MOMENTS = ("n", "mean_a", "mean_b", "square_a", "square_b", "product")


def merged_moments(one: dict[str, np.ndarray], two: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of two sets of rows together; the deviations of their means enter exactly, so nothing cancels."""
    n = one["n"] + two["n"]
    weight = np.divide(one["n"] * two["n"], n, out=np.zeros_like(n), where=n > 0)
    share = np.divide(two["n"], n, out=np.zeros_like(n), where=n > 0)
    apart_a, apart_b = two["mean_a"] - one["mean_a"], two["mean_b"] - one["mean_b"]
    return {
        "n": n, "mean_a": one["mean_a"] + share * apart_a, "mean_b": one["mean_b"] + share * apart_b,
        "square_a": one["square_a"] + two["square_a"] + weight * apart_a ** 2,
        "square_b": one["square_b"] + two["square_b"] + weight * apart_b ** 2,
        "product": one["product"] + two["product"] + weight * apart_a * apart_b,
    }


def block_moments(a: np.ndarray, b: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of every column of ``a`` with every column of ``b``; NaN is missing."""
    def shifted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        present = ~np.isnan(x)
        count = present.sum(axis=0)
        shift = np.where(present, x, 0).sum(axis=0) / np.maximum(count, 1)
        return np.where(present, x - shift, 0.0), present.astype(float), shift

    x, has_x, at_x = shifted(a)
    y, has_y, at_y = shifted(b)
    n = has_x.T @ has_y
    some = np.maximum(n, 1)
    sum_x, sum_y = x.T @ has_y, has_x.T @ y
    return {
        "n": n, "mean_a": np.where(n > 0, at_x[:, None] + sum_x / some, 0),
        "mean_b": np.where(n > 0, at_y[None, :] + sum_y / some, 0),
        "square_a": (x * x).T @ has_y - sum_x ** 2 / some, "square_b": has_x.T @ (y * y) - sum_y ** 2 / some,
        "product": x.T @ y - sum_x * sum_y / some,
    }


def cross_products(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(a, n, mean_a, mean_b, square_a, square_b, product): for each column of ``left`` arrays over ``right``.

    Each partition multiplies its rows block by block, with masks of what is present. The partial
    results, a row per column and partition, are merged as a tree, ``MERGED`` of them in a task.
    """
    names = list(dict.fromkeys([*left, *right]))
    at_left, at_right = [names.index(c) for c in left], [names.index(c) for c in right]
    schema = "a int, part int, " + ", ".join(f"{m} array<double>" for m in MOMENTS)

    def frame(moments: dict[str, np.ndarray], a: list[int], part: int) -> pd.DataFrame:
        return pd.DataFrame({"a": a, "part": part, **{m: list(moments[m]) for m in MOMENTS}})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            values = batch.to_numpy(dtype=float, na_value=np.nan)
            if len(values):
                own = block_moments(values[:, at_left], values[:, at_right])
                total = own if total is None else merged_moments(total, own)
        if total is not None:
            yield frame(total, list(range(len(left))), TaskContext.get().partitionId())

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for row in group.sort_values("part").itertuples():
            own = {m: np.asarray(getattr(row, m), dtype=float)[None, :] for m in MOMENTS}
            total = own if total is None else merged_moments(total, own)
        return frame(total, [int(group["a"].iloc[0])], int(group["part"].min()) // MERGED)

    rows = nan_to_null(df).select(*[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    parts = rows.mapInPandas(partial, schema)
    sets = parts.groupBy("a", F.floor(F.col("part") / MERGED).alias("__set")).applyInPandas(merge, schema)
    return sets.groupBy("a").applyInPandas(merge, schema).drop("part")


def wide_correlation(df: DataFrame, columns: Sequence[str], block: int = BLOCK_COLUMNS) -> DataFrame:
    """The correlations of many columns; neither the driver nor the plan holds the matrix."""
    spark, out = df.sparkSession, None
    places = F.broadcast(local_table(spark, list(enumerate(columns)), "place int, name string"))
    blocks = [columns[i:i + block] for i in range(0, len(columns), block)]
    for i, left in enumerate(blocks):
        for j in range(i, len(blocks)):
            rows = cross_products(df, left, blocks[j])
            cells = rows.select((F.col("a") + i * block).alias("i"), F.posexplode(F.arrays_zip(
                "n", "square_a", "square_b", "product")).alias("j", "m")).withColumn("j", F.col("j") + j * block)
            scale = F.sqrt(F.col("m.square_a")) * F.sqrt(F.col("m.square_b"))
            cells = cells.select("i", "j", F.when((F.col("m.n") > 1) & (F.col("m.square_a") > 0) & (
                F.col("m.square_b") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("m.product") / scale))).alias("r"))
            if i < j:
                cells = cells.union(cells.select("j", "i", "r"))
            out = cells if out is None else out.union(cells)
    for end, name in (("i", "column_a"), ("j", "column_b")):
        out = out.join(places.select(F.col("place").alias(end), F.col("name").alias(name)), end)
    return out.select("column_a", "column_b", F.col("r").alias("correlation"))


def profile_tables(df: DataFrame, target: str, numerical: Sequence[str], categorical: Sequence[str]) -> dict[str, DataFrame]:
    """Every profiling table of a data set, by name."""
    from riskframe.operators.quality import target_distribution

    n_rows = df.count()
    tables = {
        "overview": overview(df),
        "numerical_summary": numeric_summary(df, numerical),
        "categorical_summary": categorical_summary(df, categorical),
        "target_distribution": target_distribution(df, target, n_rows),
        "missing_values": missing_report(df),
    }
    if numerical:
        tables["histograms"] = histogram(df, numerical)
        tables["correlation"] = correlation(df, numerical)
    if categorical:
        tables["category_shares"] = category_shares(df, categorical)
    return tables
