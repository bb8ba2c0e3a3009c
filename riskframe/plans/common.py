"""What the workflows share: reading, the quality gate and the split."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import Config
from riskframe.errors import DataValidationError
from riskframe.operators.models import LABEL
from riskframe.operators.quality import QualityReport, column_types, quality_report
from riskframe.operators.split import assign_parts, feature_projection
from riskframe.sources.tables import load_table

logger = logging.getLogger(__name__)


def read_input(spark: SparkSession, config: Config, **options: str) -> DataFrame:
    return load_table(spark, config.data.data_path, config.data.data_format, **options)


def check(df: DataFrame, config: Config) -> QualityReport:
    data = config.data
    return quality_report(df, data.target_column, data.valid_target_values, data.duplicate_check,
                          data.missing_value_threshold)


def load_and_check(spark: SparkSession, config: Config, **options: str) -> tuple[DataFrame, QualityReport]:
    """The input table and its quality report."""
    df = read_input(spark, config, **options)
    return df, check(df, config)


def gate(report: QualityReport) -> None:
    if report.has_errors:
        raise DataValidationError(f"quality errors stop the workflow: {report.errors}")


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    numerical: list[str]
    categorical: list[str]
    # Only if the settings ask for such a part.
    validation: DataFrame | None = None


def prepare(df: DataFrame, config: Config) -> Prepared:
    """Projection, split and feature typing. Rows without a target cannot be used."""
    data = config.data
    rows = feature_projection(df, data.target_column, data.excluded_columns).where(F.col(LABEL).isNotNull())
    rows = rows.withColumn(LABEL, F.col(LABEL).cast("double"))
    split = config.split
    parts = assign_parts(rows, LABEL, data.id_columns, split.test_size, split.validation_size, split.random_state,
                         split.stratify)
    train, validation, test = (parts.where(F.col("part") == name).drop("part")
                               for name in ("train", "validation", "test"))
    numerical, categorical = column_types(train.schema, [LABEL, *data.id_columns], data.numerical_columns,
                                          data.categorical_columns)
    return Prepared(train, test, numerical, categorical, validation if split.validation_size else None)
