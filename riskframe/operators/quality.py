"""Table quality: fatal checks, missing values, duplicates, target values, schema."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.errors import DataValidationError, SchemaValidationError
from riskframe.functions.columns import is_missing, is_numeric, kept, quoted, to_long
from riskframe.functions.local import local_table

logger = logging.getLogger(__name__)

REPORT_MISSING_ABOVE = 0.5
LISTED_VALUES = 10


def column_types(
    schema: T.StructType,
    exclude: Sequence[str] = (),
    numeric_override: Sequence[str] | None = None,
    categorical_override: Sequence[str] | None = None,
) -> tuple[list[str], list[str]]:
    """Numerical and categorical columns by type; overrides must cover every column."""
    names = [n for n in schema.names if n not in exclude]
    if numeric_override is not None or categorical_override is not None:
        numerical, categorical = list(numeric_override or []), list(categorical_override or [])
        left = [n for n in names if n not in numerical and n not in categorical]
        if left:
            raise ValueError(f"The overrides do not classify these columns: {left}.")
        return numerical, categorical
    numerical = [n for n in names if is_numeric(schema[n].dataType)]
    return numerical, [n for n in names if n not in numerical]


def require_rows(df: DataFrame) -> None:
    if not df.columns:
        raise DataValidationError("The table has no columns.")
    if df.isEmpty():
        raise DataValidationError("The table has no rows.")


def require_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise DataValidationError(f"No target column {target!r}; the columns are {df.columns}.")


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing_count, n_rows, missing_fraction) from one aggregation over the input."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)
    ])
    return counts.select("n_rows", F.inline(rows)).select(
        "column", "missing_count", "n_rows",
        F.try_divide("missing_count", "n_rows").alias("missing_fraction"),
    )


def high_missing(df: DataFrame, above: float = REPORT_MISSING_ABOVE) -> DataFrame:
    return missing_counts(df).where(F.col("missing_fraction") > above)


#: Tables of more columns go by digests; narrower rows are no wider than a digest.
DIGEST_COLUMNS = 8


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row. NULLs count by their places, all NaN are alike, and so are both zeros."""
    columns = [F.col(quoted(c)) for c in df.columns]
    gaps = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(gaps, *columns).alias("__one"), F.xxhash64(F.lit("second"), *reversed(columns), gaps).alias("__two")]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first copy. NULLs, and NaNs, equal each other.

    Of wide tables only 128-bit digests are shuffled; rows whose digest repeats are then compared in full, so
    the count is exact and unique rows never move whole.
    """
    rows = df
    if len(df.columns) > DIGEST_COLUMNS:
        digests = df.select(*row_digest(df))
        repeated = digests.groupBy("__one", "__two").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        rows = df.select("*", *row_digest(df)).join(repeated, ["__one", "__two"], "left_semi")
    copies = rows.groupBy(*[F.col(quoted(c)) for c in rows.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def target_distribution(df: DataFrame, target: str, n_rows: int | None = None) -> DataFrame:
    """(target, n, share) with a NULL group for missing targets."""
    total = df.count() if n_rows is None else n_rows
    value = F.when(~is_missing(df, target), F.col(quoted(target)))
    return df.groupBy(value.alias("target")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "share", F.col("n") / F.lit(total))


@dataclass
class TargetCheck:
    """What the target's distinct values say; ``errors`` abort a workflow."""

    n_rows: int
    n_missing: int
    n_distinct: int
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)


def check_target(distribution: DataFrame, allowed: Sequence[Any] | None = None) -> TargetCheck:
    """Checks the target from its value counts.

    Value counts are aggregated again before anything reaches the driver, so a
    continuous target does no harm. A target with missing values only raises.
    """
    with kept(distribution) as counts:
        return _check_counts(counts, allowed)


def _check_counts(distribution: DataFrame, allowed: Sequence[Any] | None) -> TargetCheck:
    value = F.col("target")
    counts = distribution.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count(value).alias("n_distinct"),
    ).first()
    check = TargetCheck(counts["n_rows"], counts["n_missing"], counts["n_distinct"])
    if check.n_rows == check.n_missing:
        raise DataValidationError("The target column holds only missing values.")
    if check.n_missing:
        share = check.n_missing / check.n_rows
        check.warnings.append(
            f"The target has {check.n_missing} missing values ({share:.2%}); "
            "these rows cannot be used for training.")

    def listed(rows: DataFrame) -> list[Any]:
        ordered = rows.orderBy(value.cast("string")).select("target").limit(LISTED_VALUES)
        return [r["target"] for r in ordered.collect()]

    if allowed is not None:
        outside = listed(distribution.where(value.isNotNull() & ~value.isin(*allowed)))
        if outside:
            check.errors.append(
                f"The target holds values outside {list(allowed)}, for example {outside}.")
    elif check.n_distinct != 2:
        check.warnings.append(
            f"The target has {check.n_distinct} unique values, for example "
            f"{listed(distribution.where(value.isNotNull()))}; two were expected. "
            "Name the valid values if this is intended.")
    return check


def target_check(df: DataFrame, target: str, allowed: Sequence[Any] | None = None) -> DataFrame:
    """The target check as one row."""
    check = check_target(target_distribution(df, target, n_rows=1), allowed)
    return local_table(
        df.sparkSession, [(check.n_rows, check.n_missing, check.n_distinct, len(check.warnings), len(check.errors))],
        "n_rows bigint, n_missing bigint, n_distinct bigint, n_warnings bigint, n_errors bigint")


@dataclass
class QualityReport:
    n_rows: int
    n_columns: int
    duplicate_rows: int | None
    missing: dict[str, int]
    numerical_columns: list[str]
    categorical_columns: list[str]
    target_distribution: DataFrame
    warnings: list[str]
    errors: list[str]
    missing_above: float = REPORT_MISSING_ABOVE

    @property
    def has_errors(self) -> bool:
        return bool(self.errors)

    @property
    def missing_fraction(self) -> dict[str, float]:
        return {c: n / self.n_rows for c, n in self.missing.items()}

    def document(self) -> dict[str, Any]:
        """The report, with the counts of the most frequent target values."""
        return {
            "n_rows": self.n_rows,
            "n_columns": self.n_columns,
            "duplicate_rows": self.duplicate_rows,
            "missing_values": self.missing,
            "missing_fraction": self.missing_fraction,
            "numerical_columns": self.numerical_columns,
            "categorical_columns": self.categorical_columns,
            # As many as a warning would name; all of them are in the table.
            "target_counts": {str(r["target"]): r["n"] for r in self.target_distribution.orderBy(
                F.desc("n"), "target").limit(LISTED_VALUES).collect()},
            "warnings": self.warnings,
            "errors": self.errors,
        }

    def table(self) -> DataFrame:
        """(check, column, value, severity), value counts of the target included."""
        spark = self.target_distribution.sparkSession
        rows = [("n_rows", None, str(self.n_rows), "info"),
                ("n_columns", None, str(self.n_columns), "info")]
        if self.duplicate_rows is not None:
            rows.append(("duplicate_rows", None, str(self.duplicate_rows),
                         "warning" if self.duplicate_rows else "info"))
        for c, n in self.missing.items():
            severity = "warning" if n / self.n_rows > self.missing_above else "info"
            rows.append(("missing_count", c, str(n), severity))
        rows += [("numerical_column", c, None, "info") for c in self.numerical_columns]
        rows += [("categorical_column", c, None, "info") for c in self.categorical_columns]
        rows += [("warning", None, text, "warning") for text in self.warnings]
        rows += [("error", None, text, "error") for text in self.errors]
        fixed = local_table(spark, rows, "check string, column string, value string, severity string")
        counts = self.target_distribution.select(
            F.lit("target_count").alias("check"), F.col("target").cast("string").alias("column"),
            F.col("n").cast("string").alias("value"), F.lit("info").alias("severity"))
        return fixed.unionByName(counts)


def quality_report(
    df: DataFrame,
    target: str,
    allowed: Sequence[Any] | None = None,
    check_duplicates: bool = True,
    missing_above: float = REPORT_MISSING_ABOVE,
) -> QualityReport:
    """All checks. Structural faults raise; quality issues are collected.

    Three passes: missing counts, target counts, duplicates.
    """
    require_target(df, target)
    rows = missing_counts(df).collect()
    n_rows = rows[0]["n_rows"] if rows else 0
    if not n_rows:
        raise DataValidationError("The table has no rows.")
    missing = {r["column"]: r["missing_count"] for r in rows}

    distribution = target_distribution(df, target, n_rows)
    warnings: list[str] = []
    errors: list[str] = []
    try:
        check = check_target(distribution, allowed)
        warnings, errors = check.warnings, check.errors
    except DataValidationError as error:
        errors.append(str(error))

    duplicates = None
    if check_duplicates:
        duplicates = duplicate_count(df).first()["duplicate_rows"]
        if duplicates:
            warnings.append(f"Found {duplicates} duplicate rows.")
    mostly_missing = [c for c, n in missing.items() if n / n_rows > missing_above]
    if mostly_missing:
        warnings.append(f"Columns with a share of missing values above {missing_above:g}: {mostly_missing}")
    numerical, categorical = column_types(df.schema, exclude=[target])
    for text in warnings:
        logger.warning(text)
    return QualityReport(n_rows, len(df.columns), duplicates, missing, numerical, categorical,
                         distribution, warnings, errors, missing_above)


@dataclass(frozen=True)
class FeatureSchema:
    """The feature columns a model was fitted on."""

    numerical: tuple[str, ...]
    categorical: tuple[str, ...]

    @property
    def names(self) -> tuple[str, ...]:
        return self.numerical + self.categorical

    def require(self, df: DataFrame) -> None:
        """Raises if a feature column is missing. Reads the schema only."""
        missing = sorted(set(self.names) - set(df.columns))
        if missing:
            raise SchemaValidationError(f"The input lacks the columns {missing}.")

    def validate(self, df: DataFrame, known: Sequence[str] = ()) -> None:
        """The check at inference: missing columns raise, extra ones are reported and ignored."""
        self.require(df)
        extra = sorted(set(df.columns) - set(self.names) - set(known))
        if extra:
            logger.warning("columns not seen in training are ignored: %s", extra)


def unseen_categories(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) pairs of ``test`` that ``train`` never shows; NULL is no category."""
    def pairs(df: DataFrame) -> DataFrame:
        return to_long(df, columns).where("value is not null").distinct()

    return pairs(test).join(pairs(train), ["column", "value"], "left_anti")
