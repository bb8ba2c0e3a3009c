"""Plain versions by definition: base spans, Order MinHash, mixture likelihoods, votes; and odd tables for each operator."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import (
    chat_tree, host_reputation, language_mixture, order_minhash, packing, quality_votes, secret_lexing,
)
from riskframe.llm.queries import BYTE_VOCABULARY, LLM_QUERIES, WORD_VOCABULARY, tokenizer_path

P = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.01"
LONG = " ".join(f"Wört{i % 977}, été." for i in range(60_000))


def test_base_counts_against_another_matcher(spark):
    """The numbers of base spans of whole documents, as another regular expression engine finds them."""
    got = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"]) for r in LLM_QUERIES["op1_assignment_lexing"](spark, FOLDER).collect()}
    wanted = duckdb.sql(rf"""
        SELECT doc_id,
          len(list_filter(regexp_extract_all(coalesce(text, ''),
            '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 8)),
          len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16)),
          len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 32))
        FROM '{FOLDER}/documents.parquet'""").fetchall()
    assert got == {r[0]: r[1:] for r in wanted} and sum(sum(v) for v in got.values()) > 0


def test_order_minhash_against_a_plain_sort():
    """Each tuple by sorting all numbered k-mers by their products, then by position."""
    def plain(text, k=order_minhash.K, picks=order_minhash.PICKS, tuples=order_minhash.TUPLES):
        mix = order_minhash.mix
        codes = np.array([ord(c) for c in text], dtype=np.uint64)
        width = min(k, len(codes))
        kmers, seen, numbered = [], {}, []
        for i in range(len(codes) - width + 1):
            value = 0
            for c in codes[i:i + width].tolist():
                value = (value * int(order_minhash._BASE) + c) % 2**64
            kmers.append(int(mix(np.array([value], dtype=np.uint64))[0]))
            number = seen.get(text[i:i + width], 0)
            seen[text[i:i + width]] = number + 1
            shifted = (kmers[-1] + number * 0xD6E8FEB86659FD93) % 2**64
            numbered.append(int(mix(np.array([shifted], dtype=np.uint64))[0]) >> 32)
        out = ""
        for seed in order_minhash._seeds(tuples).tolist():
            ranked = sorted(range(len(kmers)), key=lambda i: ((numbered[i] * seed) % 2**32, i))[:picks]
            value = 0
            for i in sorted(ranked):
                mixed = (value * int(order_minhash._BASE) + kmers[i]) % 2**64
                value = int(mix(np.array([mixed], dtype=np.uint64))[0])
            out += f"{value >> 32:08x}"
        return out

    for text in ["abc", "abcdefgh", "the quick brown fox jumps over the lazy dog", "ab" * 60, "éü日本 " * 30]:
        assert order_minhash.order_minhash(text) == plain(text), text


def test_mixture_is_at_a_maximum():
    """The shares of the EM are no worse than any shares nearby, by the likelihood's definition."""
    rng = np.random.default_rng(5)
    likelihood = rng.dirichlet(np.ones(40), size=3).T
    counts = rng.multinomial(4000, likelihood @ np.array([0.6, 0.3, 0.1])).astype(float)
    share, value = language_mixture.proportions(likelihood, counts)
    assert value == pytest.approx(float((counts * np.log(likelihood @ share)).sum()))
    assert np.abs(share - [0.6, 0.3, 0.1]).max() < 0.08
    for _ in range(200):
        near = np.clip(share + rng.normal(scale=0.02, size=3), 1e-9, None)
        assert (counts * np.log(likelihood @ (near / near.sum()))).sum() <= value + 0.2  # it stops when a round gains little


def test_votes_against_a_full_sort():
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["ab", "Cde", "x1", "LONGWORD", "é.", "ok"], size=rng.integers(1, 40))) for _ in range(120)]
    counts = np.stack([quality_votes.term_counts(t) for t in texts])
    idf = np.ones(counts.shape[1], dtype=np.float32)
    axes = quality_votes.latent_axes(quality_votes._weighted(counts, idf), 8)
    vectors = quality_votes._unit(quality_votes._weighted(counts, idf) @ axes)
    labels = rng.integers(0, 2, 120).astype(float)
    model = quality_votes.QualityVotes(idf, axes, vectors, labels, 0.5)
    asked = texts[:20] + ["ab ab Cde", "zzzzzz"]
    for text, score in zip(asked, model.scores(asked), strict=True):
        own = quality_votes._unit((quality_votes._weighted(quality_votes.term_counts(text)[None, :], idf) @ axes))[0]
        cosines = vectors @ own
        order = sorted(range(120), key=lambda i: -cosines[i])
        kth = cosines[order[quality_votes.NEIGHBOURS - 1]]
        low, high = [], []  # ties at the last neighbour may go either way
        for pick, out in ((0, low), (1, high)):
            best = sorted(range(120), key=lambda i: (-cosines[i] if abs(cosines[i] - kth) > 1e-5 else -kth, labels[i] != pick))
            best = best[:quality_votes.NEIGHBOURS]
            weight = np.clip(cosines[best], 0, 1).astype(float) ** quality_votes.SHARPNESS
            out.append(((weight * labels[best]).sum() + 0.005) / (weight.sum() + 0.01))
        assert low[0] - 1e-3 <= score <= high[0] + 1e-3


ODD = [(None, None), (1, ""), (1, ""), (2, " \n"), (3, LONG), (2**60 + 1, "plain words here"), (None, "no id")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr(
        "*", "1 as score", "2 as predicted", "'x' as lang_pred", "3 as fingerprint", "4 as ids", "5 as languages", "6 as edited").coalesce(1)


def test_odd_rows_of_fingerprints_languages_quality_and_packing(spark, odd):
    ids = sorted(str(r[0]) for r in ODD)
    found = order_minhash.edit_likeness(spark, odd)
    assert sorted(str(r["doc_id"]) for r in found.collect()) == ids
    langs, table = language_mixture.fit_languages(spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)],
        "doc_id long, text string, lang string"))
    rows = language_mixture.predict_languages(spark, odd, langs, table)
    assert sorted(str(r["doc_id"]) for r in rows.collect()) == ids
    assert {r["lang_pred"] for r in rows.where("trim(replace(text, '\n', '')) = '' or text is null").collect()} == {"und"}
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality_votes.fit_quality(odd, labels)
    scored = quality_votes.score_quality(spark, odd, model)
    assert sorted(str(r["doc_id"]) for r in scored.collect()) == ids and scored.where("score between 0 and 1").count() == len(ODD)
    pieces = packing.pack_documents(odd, tokenizer_path(WORD_VOCABULARY))
    assert pieces.groupBy("doc_id").count().count() == 5
    for frame in (order_minhash.edit_likeness(spark, odd.limit(0)), language_mixture.predict_languages(spark, odd.limit(0), langs, table),
                  quality_votes.score_quality(spark, odd.limit(0), model), packing.pack_documents(odd.limit(0), tokenizer_path(WORD_VOCABULARY))):
        assert frame.count() == 0
    assert quality_votes.score_quality(spark, odd, quality_votes.fit_quality(odd, labels.limit(0))).where("score = 0.5").count() == len(ODD)


def test_odd_pages_conversations_and_masks(spark, odd):
    pages = spark.createDataFrame([(None, None, None), (1, "x", "<p>"), (2, "http://A.b/c?d", LONG), (2, "http://A.b/c?d", LONG)],
                                  "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as path", "3 as rule")
    got = host_reputation.filter_urls(pages).collect()
    assert sorted((str(r["page_id"]), r["host"], r["path"]) for r in got) == [
        ("1", "", ""), ("2", "a.b", "/c"), ("2", "a.b", "/c"), ("None", "", "")]
    assert host_reputation.filter_urls(pages.limit(0)).count() == 0
    turns = spark.createDataFrame([(None, 0, None, None), (None, 0, None, None), (1, None, "user", LONG), (1, 1, "assistant", "")],
                                  "conv_id long, turn long, role string, text string").selectExpr("*", "'n' as node", "1 as depth")
    path = tokenizer_path(BYTE_VOCABULARY)
    tree, ends = chat_tree.chat_tree(spark, turns, path)
    back = ends.join(chat_tree.read_back(tree, ends, path), "node")
    digest = hashlib.sha256(f"user\n{LONG}\nassistant\n\n".encode()).hexdigest()
    assert {(r["conv_id"], r["n_turns"]) for r in back.collect()} == {(None, 2), (1, 2)}
    assert back.where(F.col("turns_sha256") == digest).count() == 1
    assert chat_tree.chat_tree(spark, turns.limit(0), path)[1].count() == 0
    masked = secret_lexing.mask_secrets(odd.limit(0))
    assert masked.columns == odd.columns and masked.count() == 0


def test_pipeline_stages_in_order_on_planted_rows(spark, tmp_path):
    """Toxic rows go first, then all but one of near copies, then contaminated rows; secrets are masked, the rest is packed."""
    import corpus_pipeline

    def prose(i):
        return " ".join(f"word{(i * 31 + k * 7) % 900}x{k}" for k in range(80))

    passage = " ".join(f"item{k}" for k in range(30))
    rows = [(i, prose(i)) for i in range(60)]
    rows += [(100 + i, prose(i) + " vileword vileness badly") for i in range(60, 120)]
    rows += [(300, prose(5)), (301, prose(5).upper()), (302, prose(200) + " " + passage), (303, prose(201) + ' password = "hunter2hunter2"'),
             (None, None), (304, "")]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(100 <= i < 300)) for i, _ in rows if i is not None], "doc_id long, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    wanted = {i for i, _ in rows if i is None or not 100 <= i < 300}
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        wanted -= {"near_duplicates": {300, 301}, "decontamination": {302}}.get(name, set())
        assert {r["doc_id"] for r in kept.select("doc_id").collect()} == wanted, name
        seen.append(name)
    assert seen == ["toxicity", "near_duplicates", "decontamination", "secrets"]
    text = kept.where("doc_id = 303").first()["text"]
    assert "hunter2" not in text and "[SECRET]" in text
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == wanted
    assert corpus_pipeline.ORACLE_SQL is None
