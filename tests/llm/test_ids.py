"""Ids beside nulls stay what they are, and repeated or null items are found, in every text operator."""

import pytest

from riskframe.llm import chat_tree, decontaminate, packing, secret_lexing
from riskframe.llm.queries import LLM_ORACLES, LLM_QUERIES, BYTE_VOCABULARY, WORD_VOCABULARY, tokenizer_path

P = pytest.importorskip("public_tokenizers")
IDS = [2**60 + 1, None, 2**60 + 2]


def folder_of(spark, path):
    """The six tables, each in one partition, with ids that doubles cannot hold beside a null."""
    texts = ["the first plain text with words of its own", None, 'here password = "hunter2hunter2" is a text apart']
    tables = {
        "documents": (list(zip(IDS, texts, ["en", "fr", None], ["s"] * 3, [1, 2, 3])),
                      "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, 1, 0) for i in IDS], "doc_id long, quality int, toxic int"),
        "pages": ([(i, "http://a.example.org/x", "<p>hi</p>") for i in IDS], "page_id long, url string, html string"),
        "benchmark": ([(IDS[0], texts[0]), (None, texts[2])], "item_id long, text string"),
        "conversations": ([(i, t, r, f"{r} says {t}.") for i in IDS for t, r in enumerate(["user", "assistant"])],
                          "conv_id long, turn long, role string, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return folder_of(spark, tmp_path_factory.mktemp("ids"))


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - {"pipeline"}))
def test_ids_beside_nulls(spark, folder, name):
    rows = LLM_QUERIES[name](spark, folder).collect()
    key = next(c for c in ("conv_id", "page_id", "doc_id") if c in rows[0].__fields__)
    found = {r[key] for r in rows}
    if name.startswith("op13"):
        assert {IDS[0], IDS[2]} == found and {r["item_id"] for r in rows} == {IDS[0], None}
    elif name.startswith("op5"):
        assert {(r["doc_id"], r["item_id"]) for r in rows} == {(IDS[0], IDS[0]), (IDS[2], None)}
    else:
        assert found - {-1} == set(IDS)


def test_pipeline_keeps_ids(spark, folder):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == {None}  # both other texts are items of the benchmark


def test_contained_items_with_repeated_and_null_ids(spark, tmp_path):
    import duckdb

    passage = "one two three four five six seven eight nine ten"
    other = "alpha beta gamma delta epsilon zeta eta theta"
    docs = [(1, f"before {passage} after"), (2, f"x {other} y"), (3, passage + " " + other), (4, "nothing"), (None, other)]
    items = [(7, passage), (7, other), (None, passage), (None, other), (9, None), (9, ""), (8, other), (8, other)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(str, (tuple(r) for r in LLM_QUERIES["op5_minhash_containment"](spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == sorted(map(str, con.execute(LLM_ORACLES["op5_minhash_containment"]).fetchall()))
    assert {r.split(",")[0] for r in got} == {"(1", "(2", "(3", "(None"} and len(got) == 2 + 3 + 3 + 3
    clash = spark.createDataFrame([(1, passage, "a"), (1, "clean", "b")], "doc_id long, text string, __row string")
    left = decontaminate.drop_contaminated(spark, clash, spark.createDataFrame(items, "item_id long, text string"))
    assert [tuple(r) for r in left.collect()] == [(1, "clean", "b")]


def test_operators_that_pass_ids_through_python(spark):
    docs = spark.createDataFrame([(i, f"word {i}") for i in IDS], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in secret_lexing.scan_secrets(docs).collect()} == set(IDS)
    assert {r["doc_id"] for r in packing.pack_documents(docs, tokenizer_path(WORD_VOCABULARY)).collect()} == set(IDS)
    turns = spark.createDataFrame([(i, 0, "user", "a") for i in IDS], "conv_id long, turn long, role string, text string")
    _, ends = chat_tree.chat_tree(spark, turns.coalesce(1), tokenizer_path(BYTE_VOCABULARY))
    assert {r["conv_id"] for r in ends.collect()} == set(IDS)
