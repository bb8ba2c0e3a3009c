"""Small tables made on the driver, as local relations of the plan."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {
    "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(),
    "string": pa.string(), "boolean": pa.bool_(),
}


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few rows; ``schema`` is a DDL list of simple columns.

    The Arrow route turns small data into a local relation, which needs no job to
    scan and has a known size, so that a join with it is broadcast.
    """
    fields = [part.split() for part in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    table = pa.table(
        [pa.array(values, type=_ARROW[dtype]) for values, (_, dtype) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )
    return spark.createDataFrame(table)
