"""Report sinks: one-row JSON documents and result tables."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from riskframe.errors import BundleLoadError
from riskframe.functions.local import local_table


def write_json(spark: SparkSession, document: dict[str, Any], uri: str) -> str:
    """Writes a report document as one JSON row below ``uri``."""
    text = json.dumps(document, default=str, sort_keys=True)
    local_table(spark, [(text,)], "value string").write.mode("overwrite").text(uri)
    return uri


def read_json(spark: SparkSession, uri: str) -> dict[str, Any]:
    rows = spark.read.text(uri).take(1)
    if not rows:
        raise BundleLoadError(f"no document at {uri}")
    return json.loads(rows[0]["value"])


def write_table(df: DataFrame, uri: str, fmt: str = "csv") -> str:
    """Writes a result table, CSV by default, with a header."""
    writer = df.write.mode("overwrite")
    (writer.option("header", "true").csv(uri) if fmt == "csv" else writer.format(fmt).save(uri))
    return uri


def _hadoop(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Existence through the Hadoop file system, so object stores work too."""
    system, path = _hadoop(spark, uri)
    return system.exists(path)


def is_file(spark: SparkSession, uri: str) -> bool:
    system, path = _hadoop(spark, uri)
    return system.exists(path) and system.getFileStatus(path).isFile()
