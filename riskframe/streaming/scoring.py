"""Scoring and explaining files as they arrive.

Both are stateless projections: no watermark and no state store are involved, and
a restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskframe.operators.attribution import Attributor
from riskframe.operators.bundle import Bundle
from riskframe.operators.scoring import RISK_LABELS, explain, score
from riskframe.sources.sinks import is_file


def feature_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                   **options: str) -> DataFrame:
    """A stream over a folder of files, or over one file. The schema is pinned, as streams do not infer it."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    if is_file(spark, path):
        # A file source watches folders, so a single file is a filtered folder.
        path, options = folder, {"pathGlobFilter": name, **options}
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def score_stream(stream: DataFrame, bundle: Bundle, keys: Sequence[str],
                 risk_labels: tuple[str, str] = RISK_LABELS) -> DataFrame:
    _require_stream(stream)
    return score(stream, bundle, keys, risk_labels)


def explain_stream(stream: DataFrame, bundle: Bundle, keys: Sequence[str], top_n: int = 5,
                   attributor: Attributor | None = None) -> DataFrame:
    _require_stream(stream)
    return explain(stream, bundle, keys, top_n, attributor)


def write_stream(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 fmt: str = "parquet") -> StreamingQuery:
    """Appends results to ``path``; ``available_now`` stops after the files present at the start."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def _require_stream(df: DataFrame) -> None:
    if not df.isStreaming:
        raise ValueError("a streaming DataFrame is needed; use the batch functions for tables")
