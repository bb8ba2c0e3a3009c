"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SHARES = 1 << 30


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, most_rows: int, where: Column | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, text, label`` of about ``most_rows`` labelled rows, or of all if there are fewer.

    Rows are taken by a hash of their id, so the sample does not depend on partitioning.
    ``where`` is a condition on the id column of ``labels``. Repeated labels of an id count once, 1 before
    0; null labels and ids are left out. The ids of the sample are broadcast: their number
    is bounded by ``most_rows``.
    """
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if where is not None:
        rows = rows.where(where)
    rows = rows.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("label"))
    size = rows.count()
    if size > most_rows:
        share = int(_SHARES * most_rows / size)
        rows = rows.where(F.pmod(F.xxhash64("__id"), F.lit(_SHARES)) < share)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(rows), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")
