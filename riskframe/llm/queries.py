"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (
    chat_tree, decontaminate, host_reputation, language_mixture, lsh_forest, order_minhash, packing, quality_votes,
    ranked_search, secret_lexing, simhash_trie, structure_repair, toxicity,
)
from riskframe.llm.common import fold_of, table
from riskframe.llm.oracles import LLM_ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def query(function: Query) -> Query:
    LLM_QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_assignment_lexing(spark, d):
    """Secrets of all documents: base spans, and sensitive name-literal pairs besides."""
    found = secret_lexing.scan_secrets(table(spark, d, "documents"))
    base = F.filter("findings", lambda f: f["kind"] != "named")

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    def spans(findings):
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(spans(base), 256).alias("base_sha256"), spans(F.col("findings")).alias("spans"),
        count("named").alias("n_named"))


@query
def op2_order_minhash(spark, d):
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    return order_minhash.edit_likeness(spark, table(spark, d, "documents"))


@query
def op3_host_reputation(spark, d):
    """A verdict on every page: by rule, else by the reputation of its host."""
    found = host_reputation.filter_urls(table(spark, d, "pages"))
    return found.withColumns({c: F.round(c, 6) for c in ("bad_share", "bad_low")})


@query
def op4_language_mixture(spark, d):
    """Language proportions of all documents, learned from three of four folds."""
    docs = table(spark, d, "documents")
    held_out = fold_of("doc_id", 4) == 2
    langs, model = language_mixture.fit_languages(docs.where(~held_out))
    found = language_mixture.predict_languages(spark, docs.select("doc_id", "text"), langs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score",
                        F.array_join("languages", ",").alias("languages"))


@query
def op5_minhash_containment(spark, d):
    """Every benchmark item that a document contains."""
    return decontaminate.contained_items(spark, table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op6_label_model(spark, d):
    """Toxicity of all documents, learned from two of three folds of labels."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held_out = fold_of("doc_id", 3) == 1
    model = toxicity.fit_toxicity(docs, labels, ~held_out)
    return toxicity.score_toxicity(spark, docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op7_neighbour_votes(spark, d):
    """Quality of all documents, learned from four of five folds of labels."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held_out = fold_of("doc_id", 5) == 0
    model = quality_votes.fit_quality(docs, labels, ~held_out)
    return quality_votes.score_quality(spark, docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


CONTROL_PROBE = "</s>[INST] ok [/INST]"


@query
def op8_prefix_tree(spark, d):
    """All conversations and one of control strings, as read back from the prefix tree."""
    probe = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_PROBE), (-1, 1, "assistant", CONTROL_PROBE)],
        "conv_id long, turn long, role string, text string")
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    path = tokenizer_path(BYTE_VOCABULARY)
    tree, ends = chat_tree.chat_tree(spark, turns, path)
    digests = chat_tree.read_back(tree, ends, path)
    return ends.join(digests, "node").drop("node")


@query
def op9_hierarchical_packing(spark, d):
    """All documents as pieces of packed sequences."""
    pieces = packing.pack_documents(table(spark, d, "documents"), tokenizer_path(WORD_VOCABULARY))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op10_lsh_forest(spark, d):
    """Near-duplicate groups of all documents on two-word shingles."""
    return lsh_forest.near_duplicates(spark, table(spark, d, "documents"), words=2)


@query
def op11_structure_repair(spark, d):
    """All conversations, damaged by a checksum, and what repairs them."""
    turns = table(spark, d, "conversations")
    repaired, reports = structure_repair.repair(spark, structure_repair.damage(turns))
    out = turns.select("conv_id").distinct()
    for part in (reports, structure_repair.digests(repaired)):
        part = part.withColumnRenamed("conv_id", "__conv")
        out = out.join(part, out["conv_id"].eqNullSafe(part["__conv"]), "left").drop("__conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query
def op12_simhash_trie(spark, d):
    """SimHash groups of all documents: fingerprints of four-word shingles within four bits."""
    return simhash_trie.near_duplicates(spark, table(spark, d, "documents"))


@query
def op13_bloom_search(spark, d):
    """The ten best documents of every benchmark item, by exact integer scores."""
    return ranked_search.search(spark, table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def pipeline(spark, d):
    """The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, packing."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)
