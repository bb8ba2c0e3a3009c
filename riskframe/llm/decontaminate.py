"""Benchmark decontamination with DataFrame functions only: size-partitioned MinHash search, exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import ROW, free_name, settle, with_row_keys

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Sketch entries of all items that are broadcast at most; more of them are joined by a shuffle.
BROADCAST_ROWS = 200_000
RESULT = T.StructType([T.StructField("shared", T.LongType()), T.StructField("item_shingles", T.LongType()),
                       T.StructField("containment", T.DoubleType())])


def _words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(width: int, make) -> Column:
    """One value per run of ``width`` words of the column ``words``; none for fewer words."""
    def at(word: Column, i: Column) -> Column:
        return make(word, *[F.get("words", i + step) for step in range(1, width)])

    starts = F.slice(F.col("words"), F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(0)))
    return F.array_distinct(F.transform(starts, at))


def _hashed(width: int) -> Column:
    return _shingles(width, lambda *words: F.xxhash64(F.lit(width), *words))


def _spelled(width: int) -> Column:
    return _shingles(width, lambda *words: F.concat_ws(" ", *words))


def sketch_items(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int = SHINGLE_WORDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``item_id, width, n_shingles, upper, sketch``: the smallest shingle hashes of each item.

    Items are partitioned by size; ``upper`` bounds the shingles of a partition (a power
    of two). A document that contains the share ``containment`` of an item lacks at most
    ``(1 - containment) * n`` of its shingles, so among that many plus one there is one
    that it has: with ``floor((1 - containment) * upper) + 1`` minima the search loses nothing.
    Items of fewer than ``words`` words are one shingle, items without words are left out.
    """
    rows = items.select(F.col(id_col).alias("item_id"), _words(F.col(text_col)).alias("words"))
    rows = rows.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(words)))
    hashes = F.lit(None).cast("array<long>")
    for width in range(1, words + 1):
        hashes = F.when(F.col("width") == width, _hashed(width)).otherwise(hashes)
    rows = rows.withColumn("hashes", hashes).withColumn("n_shingles", F.size("hashes").cast("long"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n_shingles"))).cast("long")
    minima = (F.floor(F.lit(1 - containment) * F.col("upper") + F.lit(1e-9)) + 1).cast("int")
    return rows.withColumn("upper", upper).select(
        "item_id", "width", "n_shingles", "upper",
        F.slice(F.array_sort("hashes"), F.lit(1), minima).alias("sketch"))


def contained_items(
    spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", words: int = SHINGLE_WORDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment``: every item that a document contains.

    A pair counts when at least the share ``containment`` of the item's distinct
    ``words``-word shingles is in the document, compared as text. Candidates are documents
    with a shingle among the minima of an item (see ``sketch_items``); only they are
    verified. Documents are searched whole, each where it is read, against the sketches
    of all items; these are broadcast while they have at most ``BROADCAST_ROWS`` entries,
    else joined by a shuffle.

    Null, empty and blank texts contain nothing. Rows that repeat an id count as one
    document with its best row; a null id is an id. So it is with items: each row is searched for by itself, and
    of the rows of one ``item_id`` the best contained one tells ``shared``, ``item_shingles`` and ``containment``.
    Items with equal texts all match. Other columns are ignored. Without documents or items the result is empty.
    """
    items = with_row_keys(spark, items.select(F.col(item_id_col).alias("__item"), F.col(item_text_col).alias("text")))
    sketches = settle(spark, sketch_items(items, ROW, "text", words, containment), "sketches")
    picks = sketches.select("width", F.explode("sketch").alias("hash"), "item_id").distinct()
    widths = [row["width"] for row in sketches.select("width").distinct().collect()]  # at most one per word count
    sized = picks.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    source = docs.select(F.col(id_col).alias("doc_id"), _words(F.col(text_col)).alias("words"))
    if not widths:
        keys = [docs.select(F.col(id_col).alias("doc_id")).schema[0],
                items.select(F.col("__item").alias("item_id")).schema[0]]
        return spark.createDataFrame([], T.StructType(keys + RESULT.fields))

    # Hashes of all widths in use; a width is part of its hash.
    hashes = _hashed(widths[0]) if len(widths) == 1 else F.concat(*[_hashed(w) for w in sorted(widths)])
    shingles = source.select("doc_id", F.explode(hashes).alias("hash"))
    keys = picks.select("hash", "item_id")
    hits = shingles.join(F.broadcast(keys) if sized <= BROADCAST_ROWS else keys, "hash")
    found = settle(spark, hits.select("doc_id", "item_id").distinct(), "candidates")

    spelled = items.select(F.col(ROW).alias("item_id"), "__item", _words(F.col("text")).alias("words"))
    whole = F.lit(None).cast("array<string>")
    for width in sorted(widths):
        whole = F.when(F.least(F.size("words"), F.lit(words)) == width, _spelled(width)).otherwise(whole)
    spelled = spelled.where(F.size("words") > 0).select("item_id", "__item", F.size("words").alias("n_words"),
                                                         whole.alias("item_set"))
    wanted = found.groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    wanted = settle(spark, wanted.select(F.col("doc_id").alias("__doc"), "items"), "suspects")
    rows = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("__doc")))
    for width in sorted(widths):
        rows = rows.withColumn(f"set_{width}", _spelled(width))
    rows = rows.drop("words", "__doc").withColumn("item_id", F.explode("items")).drop("items")
    rows = rows.join(spelled, "item_id")
    shared = F.lit(0)
    for width in sorted(widths):
        shared = F.when(F.least(F.col("n_words"), F.lit(words)) == width,
                        F.size(F.array_intersect(f"set_{width}", "item_set"))).otherwise(shared)
    rows = rows.select("doc_id", F.col("__item").alias("item_id"), shared.cast("long").alias("shared"),
                       F.size("item_set").cast("long").alias("item_shingles"))
    rows = rows.withColumn("containment", F.col("shared") / F.col("item_shingles")).where(
        F.col("shared") >= F.lit(containment) * F.col("item_shingles") - F.lit(1e-9))
    best = rows.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("containment", "shared", "item_shingles")).alias("best"))
    return best.select("doc_id", "item_id", "best.shared", "best.item_shingles", "best.containment")


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item; each row goes or stays by its own text, whatever its id."""
    key = free_name(docs)
    rows = with_row_keys(spark, docs, key)
    leaks = contained_items(spark, rows, items, **{**options, "id_col": key}).select(F.col("doc_id").alias(key))
    return rows.join(leaks.distinct(), key, "left_anti").drop(key)
