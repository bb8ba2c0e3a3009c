"""Connected components by contraction: every round hooks each node to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import release, settle

# Pointer jumps between two contractions; more jumps save rounds on long chains.
JUMPS = 2


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (columns ``a`` and ``b``): equal roots, one component.

    Each round maps both ends of an edge to the smaller neighbours found so far and drops
    edges inside a label, so the graph shrinks at least by half; the rounds end when no
    edge is left. Every round is written to the shared folder, the one before is deleted. No node's neighbours are
    collected: minima are pre-aggregated, so a node may hold a third of all edges.
    Null ends and loops are ignored; no edges give no rows.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.where(F.col("a") != F.col("b")).select(F.explode(ways).alias("way")).select("way.*").distinct()
    both = settle(spark, both, "edges")
    labels = both.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    while not both.isEmpty():
        parents = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        parents = first = settle(spark, parents, "parents")
        for _ in range(JUMPS):
            above = parents.select(F.col("a").alias("__a"), F.col("p").alias("__p"))
            parents = parents.join(above, F.col("p") == F.col("__a"), "left").select(
                "a", F.coalesce("__p", "p").alias("p"))
        parents = settle(spark, parents, "jumped")
        ends = both
        for end in ("a", "b"):
            step = parents.select(F.col("a").alias("__a"), F.col("p").alias("__p"))
            ends = ends.join(step, F.col(end) == F.col("__a"), "left").withColumn(
                end, F.coalesce("__p", end)).drop("__a", "__p")
        step = parents.select(F.col("a").alias("__a"), F.col("p").alias("__p"))
        named = labels.join(step, F.col("root") == F.col("__a"), "left").select(
            "node", F.coalesce("__p", "root").alias("root"))
        old = labels, both, first, parents
        labels = settle(spark, named, "labels")
        both = settle(spark, ends.where(F.col("a") != F.col("b")).distinct(), "edges")
        release(spark, *old)
    return labels
