"""The canonical inputs that the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import safe_ratio


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored rows: a label and two probabilities with many ties."""
    margin = (F.col("l_quantity") - 25) / 12.0 + 5 * (F.col("l_discount") - 0.05)
    p0 = F.round(1 / (1 + F.exp(-margin)), 4)
    return (
        table(spark, sf_dir, "lineitem")
        .select((F.col("l_returnflag") == "R").cast("int").alias("label"), p0.alias("p0"))
        .withColumn("p1", F.round(0.2 + 0.25 * F.col("p0"), 6))
    )


def with_text_features(documents: DataFrame) -> DataFrame:
    """Per-row features of whole texts; narrow, so it also runs on streams. An empty text has no letters: a share of 0."""
    text = F.col("text")
    words = F.split(text, " ")
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return documents.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.round(safe_ratio(letters, F.length(text)), 6).alias("letter_share"),
        F.round(F.size(F.array_distinct(words)) / F.size(words), 6).alias("distinct_share"),
        "lang", "source",
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with text features and the quality target, NULL where not labelled."""
    features = with_text_features(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    return features.join(labels, "doc_id", "left")


def labelled_docs(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """Training rows: documents that carry the target, as ``label``."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col(target).cast("double").alias("label")).where("label is not null")
    return with_text_features(table(spark, sf_dir, "documents")).join(labels, "doc_id")


def lines_nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with missing values in one numeric and one categorical column."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_linestatus")).alias("l_linestatus"),
    )


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with order aggregates; the target is a negative balance."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.round(F.max("o_totalprice"), 2).alias("max_price"),
        F.max("o_orderstatus").alias("last_status"),
    )
    customers = table(spark, sf_dir, "customer")
    return (
        customers.join(orders, customers.c_custkey == orders.o_custkey, "left")
        .select(
            "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
            "n_orders", "total_price", "max_price", "last_status",
            (F.col("c_acctbal") < 0).cast("int").alias("target"),
        )
    )
