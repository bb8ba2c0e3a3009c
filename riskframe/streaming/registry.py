"""Streams that follow the model registry: each micro-batch is scored by the version served when it starts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.config import ArtifactConfig
from riskframe.errors import BundleLoadError
from riskframe.operators.bundle import Bundle, load_bundle
from riskframe.operators.scoring import explain, score
from riskframe.sources.sinks import path_exists

logger = logging.getLogger(__name__)

BATCH = "batch_id"


def served_version(spark: SparkSession, registry_dir: str, model_name: str | None = None) -> str:
    """The version that was registered last, of one model or of all."""
    if path_exists(spark, registry_dir):
        entries = spark.read.parquet(registry_dir)
        if model_name is not None:
            entries = entries.where(F.col("model_name") == model_name)
        row = entries.agg(F.max_by("model_version", F.struct("packaged_at_utc", "model_version")).alias("v")).first()
        if row["v"] is not None:
            return row["v"]
    raise BundleLoadError(f"no version is registered at {registry_dir}")


class Follower:
    """Writes scored or explained micro-batches; the function that ``foreachBatch`` calls.

    A batch is a folder of its own, ``batch_id=<n>``, that is overwritten when the batch runs again: after a
    failure between the write and the stream's commit no row comes twice. A version is loaded once.
    """

    def __init__(self, artifacts: ArtifactConfig, keys: Sequence[str], path: str, model_name: str | None = None,
                 top_n: int | None = None):
        self.artifacts, self.keys, self.path = artifacts, list(keys), path
        self.model_name, self.top_n = model_name, top_n
        self.loaded: dict[str, Bundle] = {}

    def bundle(self, spark: SparkSession) -> Bundle:
        version = served_version(spark, self.artifacts.registry_dir, self.model_name)
        if version not in self.loaded:
            # Only the version in use is kept.
            self.loaded = {version: load_bundle(spark, version, self.artifacts)}
            logger.info("scoring goes on with version %s", version)
        return self.loaded[version]

    def results(self, batch: DataFrame) -> DataFrame:
        bundle = self.bundle(batch.sparkSession)
        if self.top_n is None:
            return score(batch, bundle, self.keys)
        return explain(batch, bundle, self.keys, self.top_n)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.results(batch).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")


def follow_registry(
    stream: DataFrame, artifacts: ArtifactConfig, keys: Sequence[str], path: str, checkpoint: str,
    model_name: str | None = None, top_n: int | None = None, available_now: bool = True,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Scores a stream (explains it with ``top_n``) by the served version, micro-batch by micro-batch.

    ``prepare`` makes features of each micro-batch. A restart goes on from ``checkpoint``; read the
    results with ``read_results``.
    """
    follower = Follower(artifacts, keys, path, model_name, top_n)

    def work(batch: DataFrame, batch_id: int) -> None:
        follower(prepare(batch) if prepare else batch, batch_id)

    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All results with the ``batch_id`` they were written in."""
    return spark.read.parquet(path)
