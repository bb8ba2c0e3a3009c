"""Readers: CSV with pandas-like missing tokens and type inference, and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.errors import DataLoadError
from riskframe.functions.columns import nan_to_null, quoted

# The tokens that the usual CSV reader of Python takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

OVERFLOW = "__overflow"

# A plain number: Java's own suffixes (12d, 7f) and hexadecimal forms are text.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    missing_tokens: Sequence[str] = MISSING_TOKENS,
    **options: str,
) -> DataFrame:
    """Reads a table, or a folder of part files, and fails early if there is nothing in it.

    With ``schema`` the types are pinned and no inference pass runs. Without it a
    CSV table is scanned once to find the narrowest of bigint, double, boolean and
    string that fits every non-missing value of a column.
    """
    try:
        if fmt == "csv":
            df = _load_csv(spark, path, schema, missing_tokens, options)
        else:
            reader = spark.read.format(fmt).options(**options)
            df = (reader.schema(schema) if schema else reader).load(path)
        df = nan_to_null(df)
        if not df.columns:
            raise DataLoadError(f"The table at {path} is empty.")
        if df.isEmpty():
            raise DataLoadError(f"The table at {path} has no rows.")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise DataLoadError(f"No table at {path}.") from error
        raise DataLoadError(f"Cannot read {path}: {error}") from error
    except PySparkException as error:
        raise DataLoadError(f"Cannot parse {path}: {error}") from error
    return df


def _load_csv(spark, path, schema, missing_tokens, options) -> DataFrame:
    options = {"header": "true", **options}
    names = (schema.names if schema else spark.read.options(**options).csv(path).columns)
    if not names:
        raise DataLoadError(f"The file at {path} is empty.")
    # One spare column shows rows with more fields than the header; shorter rows
    # are filled with NULL.
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, OVERFLOW]])
    raw = spark.read.options(**options).schema(text).csv(path)
    fields = _without_tokens(names, missing_tokens)

    if schema is None:
        row = raw.agg(F.count_if(F.col(OVERFLOW).isNotNull()).alias("overflow"), *_fits(names, fields)).first()
        if row["overflow"]:
            raise DataLoadError(f"{row['overflow']} rows of {path} have more than {len(names)} fields.")
        schema = _narrowest(names, row)
    checked = F.when(F.col(OVERFLOW).isNotNull(), F.raise_error(
        F.lit(f"{path} has a row with more than {len(names)} fields"))).cast("boolean")
    typed = [fields[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.where(checked.isNull()).select(*typed)


def type_strings(df: DataFrame, missing_tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """A table of text columns, typed as a CSV table without a schema is: one scan, then casts."""
    fields = _without_tokens(df.columns, missing_tokens)
    schema = _narrowest(df.columns, df.agg(*_fits(df.columns, fields)).first())
    return df.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def _without_tokens(names: Sequence[str], missing_tokens: Sequence[str]) -> dict[str, Column]:
    return {n: F.when(~F.col(quoted(n)).isin(*missing_tokens), F.col(quoted(n))) for n in names}


def _fits(names: Sequence[str], fields: dict[str, Column]) -> list[Column]:
    """Per column the non-missing values, and those that are a bigint, a double, a boolean."""
    aggregates = []
    for i, n in enumerate(names):
        value = fields[n]
        number = F.when(value.rlike(NUMBER) | value.rlike(INFINITE), value)
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.count(number.try_cast("bigint")).alias(f"l{i}"),
            F.count(number.try_cast("double")).alias(f"d{i}"),
            F.count_if(F.lower(value).isin("true", "false")).alias(f"b{i}"),
        ]
    return aggregates


def _narrowest(names: Sequence[str], row: Row) -> T.StructType:
    found = []
    for i, n in enumerate(names):
        filled = row[f"n{i}"]
        if filled and row[f"l{i}"] == filled:
            dtype: T.DataType = T.LongType()
        elif row[f"d{i}"] == filled:
            # A column without any value is numeric, as an all-missing column is.
            dtype = T.DoubleType()
        elif row[f"b{i}"] == filled:
            dtype = T.BooleanType()
        else:
            dtype = T.StringType()
        found.append(T.StructField(n, dtype))
    return T.StructType(found)
