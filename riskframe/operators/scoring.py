"""Scoring and explaining with a loaded bundle; the same projection for tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.operators.attribution import Attributor, explain_rows
from riskframe.operators.bundle import Bundle
from riskframe.operators.calibration import CALIBRATED

RISK_LABELS = ("lower_risk", "higher_risk")


def score(df: DataFrame, bundle: Bundle, keys: Sequence[str],
          risk_labels: tuple[str, str] = RISK_LABELS) -> DataFrame:
    """(keys, probability, prediction, risk_label, threshold, model_version)."""
    bundle.schema.validate(df, known=keys)
    scored = bundle.predict(df.select(*{*keys, *bundle.schema.names}), known=keys)
    low, high = risk_labels
    return scored.select(
        *[F.col(quoted(k)) for k in keys],
        F.col(CALIBRATED).alias("probability"), "prediction",
        F.when(F.col("prediction") == 1, high).otherwise(low).alias("risk_label"),
        F.lit(bundle.threshold).alias("threshold"), F.lit(bundle.version).alias("model_version"))


def explain(df: DataFrame, bundle: Bundle, keys: Sequence[str], top_n: int = 5,
            attributor: Attributor | None = None) -> DataFrame:
    """The explained decision per row, with the input value of each top feature."""
    bundle.schema.validate(df, known=keys)
    attributor = attributor or bundle.attributor(df.sparkSession)
    out = explain_rows(attributor, bundle.calibrated, df, bundle.threshold, keys, top_n)
    return out.withColumn("model_version", F.lit(bundle.version))
