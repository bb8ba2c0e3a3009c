"""Column expressions used across operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.FloatType, T.DoubleType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes NULL in every floating column."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL)]
    return df.withColumns({
        name: F.when(~F.isnan(F.col(quoted(name))), F.col(quoted(name))) for name in floating
    }) if floating else df


def order_hash(keys: Sequence[str], seed: int) -> Column:
    """A shuffle order that depends on the row key and the seed only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(quoted(k)).cast("string") for k in keys]))


def checked_label(name: str) -> Column:
    """The label as 0/1; any other value, or none, fails the job."""
    value = F.col(quoted(name)).cast("double")
    return (
        F.when(value == 1.0, F.lit(1)).when(value == 0.0, F.lit(0))
        .otherwise(F.raise_error(F.lit(f"column {name} must hold 0 or 1 in every row")))
    )


def checked_score(name: str) -> Column:
    """The score as a double; a missing one fails the job."""
    value = F.col(quoted(name)).cast("double")
    missing = F.raise_error(F.lit(f"column {name} must hold a score in every row")).cast("double")
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio that is 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), as_type: str = "string",
            name: str = "column", value: str = "value") -> DataFrame:
    """One row per (row, column): a narrow expansion that scans the input once."""
    wide = df.select(
        *[F.col(quoted(k)) for k in keep],
        *[F.col(quoted(c)).cast(as_type).alias(c) for c in columns if c not in keep],
    )
    return wide.unpivot([F.col(quoted(k)) for k in keep], [F.col(quoted(c)) for c in columns],
                        name, value)


@contextmanager
def kept(df: DataFrame, columns: Sequence[str] | None = None) -> Iterator[DataFrame]:
    """The columns of ``df`` held in executor memory and disk while several passes read them.

    A frame that is held already is used as it is.
    """
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    held = (df if columns is None else df.select(*[F.col(quoted(c)) for c in columns])).persist()
    try:
        yield held
    finally:
        held.unpersist()
