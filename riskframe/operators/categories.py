"""Categories of any number: a fitted dictionary table, joined at scoring, and sparse vectors from its slots.

Nothing here grows with the number of values on the driver. The dictionary is a table of
(position, value, n, slot) in the shared folder or in a saved model's folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import PreprocessingConfig
from riskframe.functions.columns import is_missing, quoted
from riskframe.operators.quality import FeatureSchema
from riskframe.session import scratch_path
from riskframe.sources.sinks import read_json, write_json

#: Dictionaries of no more values are broadcast; larger ones are joined by a shuffle.
BROADCAST_VALUES = 100_000
#: A value with at least one in so many training rows is hot: there are at most so many, and they are broadcast.
HOT_SHARE = 1000

_ENTRIES = "value string, n bigint, slot bigint, position int"


def numbered(counts: DataFrame) -> DataFrame:
    """Adds ``slot``: the place of each value among those of its ``position``, in order, from 0.

    Values are range-sorted over all partitions; a range's offset is the number of values in the ranges before
    it, one row per range and position. No task sorts a whole column.
    """
    spark = counts.sparkSession
    path = scratch_path(spark, "sorted-values")
    rows = counts.repartitionByRange("position", "value").sortWithinPartitions("position", "value")
    rows.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("position", "range").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    before = Window.partitionBy("position").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("position", "range", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return rows.join(F.broadcast(offsets), ["position", "range"]).select(
        "value", "n", (F.col("offset") + F.col("at") - F.col("first")).alias("slot"), "position")


@dataclass
class CategoryDictionary:
    """The values of some columns with their slots, as a table at ``path``."""

    path: str
    columns: list[str]
    sizes: list[int]
    totals: list[int]
    fills: list[str | None]

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str], fill: str | None = None,
            path: str | None = None) -> "CategoryDictionary":
        """Counts and numbers the values of ``columns`` in ``train``.

        Missing values become ``fill``, or the most frequent value (the smallest on ties) if there is none. A
        column without any value has size 0 and no fill.
        """
        spark = train.sparkSession
        values = [F.when(~is_missing(train, c), F.col(quoted(c)).cast("string")) for c in columns]
        if fill is not None:
            values = [F.coalesce(v, F.lit(fill)) for v in values]
        long = train.select(F.posexplode(F.array(*values)).alias("position", "value")) if values else (
            spark.createDataFrame([], "position int, value string"))
        counts = long.where("value is not null").groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
        path = path or scratch_path(spark, "dictionary")
        numbered(counts).write.mode("overwrite").partitionBy("position").parquet(path)
        # One row a column.
        stats = {r["position"]: r for r in spark.read.schema(_ENTRIES).parquet(path).groupBy("position").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()}
        found = [stats.get(i) for i in range(len(columns))]
        return cls(path, list(columns), [r["size"] if r else 0 for r in found], [r["total"] if r else 0 for r in found],
                   [fill if fill is not None else r["mode"] if r else None for r in found])

    def entries(self, spark: SparkSession) -> DataFrame:
        """(value, n, slot, position) of all columns."""
        return spark.read.schema(_ENTRIES).parquet(self.path)

    def encode(self, df: DataFrame, output: str = "__slot") -> DataFrame:
        """Adds ``<output><i>``, the slot of each column's value; NULL for a value that the dictionary lacks.

        A small dictionary is broadcast. With a large one hot values, at most ``HOT_SHARE``, are looked up in a
        broadcast table first; their rows go on under keys of their own that match nothing, so that no
        value gathers its rows in one task of the shuffled join.
        """
        spark = df.sparkSession
        for i, c in enumerate(self.columns):
            slot, key = f"{output}{i}", f"__key{i}"
            known = F.when(~is_missing(df, c), F.col(quoted(c)).cast("string"))
            rows = df.withColumn(key, known if self.fills[i] is None else F.coalesce(known, F.lit(self.fills[i])))
            own = self.entries(spark).where(F.col("position") == i)
            if self.sizes[i] <= BROADCAST_VALUES:
                side = F.broadcast(own.select(F.col("value").alias("__value"), F.col("slot").alias(slot)))
                df = rows.join(side, F.col(key) == F.col("__value"), "left").drop("__value", key)
                continue
            hot = F.col("n") * HOT_SHARE >= self.totals[i]
            first = own.where(hot).select(F.col("value").alias("__value"), F.col("slot").alias("__hot"))
            rows = rows.join(F.broadcast(first), F.col(key) == F.col("__value"), "left").drop("__value")
            apart = F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string"))
            rows = rows.withColumn(key, F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(apart))
            rest = own.where(~hot).select(F.col("value").alias("__value"), F.col("slot").alias("__cold"))
            df = rows.join(rest, F.col(key) == F.col("__value"), "left").withColumn(
                slot, F.coalesce("__hot", "__cold")).drop("__value", "__hot", "__cold", key)
        return df

    def document(self) -> dict[str, Any]:
        return {"columns": self.columns, "sizes": self.sizes, "totals": self.totals, "fills": self.fills}

    def save(self, uri: str) -> None:
        spark = SparkSession.active()
        self.entries(spark).write.mode("overwrite").partitionBy("position").parquet(f"{uri}/entries")
        write_json(spark, self.document(), f"{uri}/columns")

    @classmethod
    def load(cls, uri: str) -> "CategoryDictionary":
        d = read_json(SparkSession.active(), f"{uri}/columns")
        return cls(f"{uri}/entries", d["columns"], d["sizes"], d["totals"], d["fills"])


@dataclass
class WidePreprocessor:
    """Imputed and scaled numbers, and one slot per category of a dictionary, as sparse vectors.

    The counterpart of ``FittedPreprocessor`` for columns with more categories than a model can list.
    """

    schema: FeatureSchema
    numerical: list[str]
    fills: dict[str, float]
    scale: dict[str, tuple[float, float]]
    dictionary: CategoryDictionary
    encode: str = "onehot"
    drop: str | None = None
    unknown: str = "ignore"
    #: There is no ``PipelineModel``: the join with the dictionary is not a stage.
    model: None = None

    @classmethod
    def fit(cls, train: DataFrame, schema: FeatureSchema, numeric: dict[str, float | None],
            scale: dict[str, tuple[float, float]], config: PreprocessingConfig) -> "WidePreprocessor":
        constant = config.categorical_impute_strategy == "constant"
        dictionary = CategoryDictionary.fit(
            train, schema.categorical, config.categorical_fill_value if constant else None)
        numerical = [c for c in schema.numerical if numeric[c] is not None]
        return cls(schema, numerical, {c: numeric[c] for c in numerical}, dict(scale), dictionary,
                   config.encode_categorical, config.onehot_drop, config.handle_unknown_categorical)

    def _first(self, i: int) -> int:
        """Slots that are left out at the start of a column."""
        size = self.dictionary.sizes[i]
        return int(self.encode == "onehot" and (self.drop == "first" or (self.drop == "if_binary" and size == 2)))

    def offsets(self) -> list[int]:
        """The first position of each category column in the vector, and the size of the vector."""
        out = [len(self.numerical)]
        for i, size in enumerate(self.dictionary.sizes):
            out.append(out[-1] + (int(size > 0) if self.encode == "ordinal" else max(0, size - self._first(i))))
        return out

    def sparse(self, df: DataFrame, output: str = "features") -> DataFrame:
        """``df`` with the parts of a sparse vector: ``type, size, indices, values``; a lazy projection and joins."""
        self.schema.require(df)
        offsets, items = self.offsets(), []
        for i, c in enumerate(self.numerical):
            value = F.coalesce(F.when(~is_missing(df, c), F.col(quoted(c)).cast("double")), F.lit(float(self.fills[c])))
            if c in self.scale:
                mean, deviation = self.scale[c]
                value = (value - F.lit(mean)) / F.lit(deviation)
            items.append(_item(F.lit(i), value))
        rows = self.dictionary.encode(df)
        for i, c in enumerate(self.dictionary.columns):
            size, slot = self.dictionary.sizes[i], F.col(f"__slot{i}")
            if not size:
                continue
            if self.unknown == "error":
                message = F.concat(F.lit(f"unknown category in column {c}: "), F.col(quoted(c)).cast("string"))
                slot = F.coalesce(slot, F.raise_error(message).cast("bigint"))
            if self.encode == "ordinal":
                items.append(_item(F.lit(offsets[i]), F.coalesce(slot, F.lit(size)).cast("double")))
            else:
                at = slot + F.lit(offsets[i] - self._first(i))
                items.append(F.when(at >= offsets[i], _item(at, F.lit(1.0))))
        kept = F.filter(F.array(*items), lambda x: x.isNotNull() & (x["value"] != 0))
        rows = rows.withColumn("__items", kept).withColumn(output, F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(offsets[-1]).alias("size"),
            F.transform("__items", lambda x: x["at"]).alias("indices"),
            F.transform("__items", lambda x: x["value"]).alias("values")))
        return rows.drop("__items", *[f"__slot{i}" for i in range(len(self.dictionary.columns))])

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """``df`` with a column of sparse vectors.

        Spark has no function that makes a sparse vector of a size that only data tells, but a vector is stored
        as its parts. So the parts are written to the shared folder and read back as vectors, JVM-side.
        """
        spark = df.sparkSession
        path = scratch_path(spark, "sparse")
        rows = self.sparse(df, output)
        rows.write.parquet(path)
        fields = [T.StructField(f.name, VectorUDT() if f.name == output else f.dataType) for f in rows.schema.fields]
        return spark.read.schema(T.StructType(fields)).parquet(path)

    def feature_map(self, spark: SparkSession) -> DataFrame:
        """(slot, transformed, original) of all positions, as a table of its own size."""
        names = [(i, f"numerical__{c}", c) for i, c in enumerate(self.numerical)]
        numbers = spark.createDataFrame(names, "slot bigint, transformed string, original string")
        offsets = self.offsets()
        columns = [(i, c, offsets[i], self._first(i)) for i, c in enumerate(self.dictionary.columns)]
        side = F.broadcast(spark.createDataFrame(columns, "position int, original string, offset bigint, first bigint"))
        rows = self.dictionary.entries(spark).join(side, "position")
        if self.encode == "ordinal":
            rows = rows.groupBy("offset", "original").agg(F.max("slot")).select(
                F.col("offset").alias("slot"), F.concat(F.lit("categorical__"), "original").alias("transformed"), "original")
        else:
            rows = rows.where(F.col("slot") >= F.col("first")).select(
                (F.col("offset") + F.col("slot") - F.col("first")).alias("slot"),
                F.concat(F.lit("categorical__"), "original", F.lit("_"), "value").alias("transformed"), "original")
        return numbers.union(rows)

    def save(self, uri: str) -> None:
        self.dictionary.save(f"{uri}/dictionary")
        write_json(SparkSession.active(), {
            "numerical": list(self.schema.numerical), "categorical": list(self.schema.categorical), "kept": self.numerical,
            "fills": [self.fills[c] for c in self.numerical], "scaled": list(self.scale),
            "means": [m for m, _ in self.scale.values()], "deviations": [s for _, s in self.scale.values()],
            "encode": self.encode, "drop": self.drop or "", "unknown": self.unknown}, f"{uri}/wide")

    @classmethod
    def load(cls, uri: str) -> "WidePreprocessor":
        d = read_json(SparkSession.active(), f"{uri}/wide")
        scale = dict(zip(d["scaled"], zip(d["means"], d["deviations"], strict=True), strict=True))
        return cls(FeatureSchema(tuple(d["numerical"]), tuple(d["categorical"])), d["kept"],
                   dict(zip(d["kept"], d["fills"], strict=True)), scale, CategoryDictionary.load(f"{uri}/dictionary"),
                   d["encode"], d["drop"] or None, d["unknown"])


def _item(at: Column, value: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), value.alias("value"))
