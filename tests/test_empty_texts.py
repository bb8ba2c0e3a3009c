"""Documents without a character: every query on whole texts runs, and agrees with its SQL where it has one."""

import random

import duckdb
import pytest

import __spark_entry__ as entry_points
from riskframe.sources.views import with_text_features
from tools.check_oracles import compare

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
N, EMPTY = 120, {7, 8, 118, 119}  # 7 and 8 are labelled
SORTED_JOIN = ["model_registry", "search_recounted"]
WITH_SQL = ["high_missing", "quality_report", "profile_workflow", "shap_additivity", "stream_parity", "reload_parity",
            "score_batch_rows", "score_stream_rows", "explained_rows", "explained_stream_rows", "importance_recounted",
            "calibrated_rows", "stream_registry"]
#: Rows of the result for each document.
WITHOUT_SQL = {"train_gbt": 1, "calibrate_prefit": 1, "calibrate_isotonic": 1, "calibrate_cv": 1, "score_batch": 1,
               "score_stream": 1, "shap_local_topn": 3, "explain_stream": 3}


def write_tables(spark, folder):
    rng = random.Random(5)
    words = ["the", "of", "risk", "42", "Haus", "ist", "--", "text", "a", "7%"]
    texts = ["" if i in EMPTY else " ".join(rng.choices(words, k=rng.randint(1, 40))) for i in range(N)]
    rows = [(i, t, rng.choice(["en", "de"]), rng.choice(["web", "book"]), len(t)) for i, t in enumerate(texts)]
    labels = [(i, int(len(texts[i]) > 60 or i % 5 == 0), int(i % 7 == 0)) for i in range(100)]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(
        f"{folder}/labels.parquet")
    return str(folder)


def sql_result(folder, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return con.execute(entry_points.oracle_sql()[name])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty_texts"))


def test_features_of_an_empty_text(spark):
    rows = [(1, "", "en", "web", 0), (2, None, "en", "web", None), (3, "ab 1 ab", "en", "web", 7), (4, "12", "en", "web", 2)]
    found = with_text_features(spark.createDataFrame(rows, DOCUMENTS)).orderBy("doc_id").collect()
    assert [(r["letter_share"], r["distinct_share"]) for r in found] == [
        (0.0, 1.0), (None, None), (round(4 / 7, 6), round(2 / 3, 6)), (0.0, 1.0)]


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, folder, name):
    problem = compare(entry_points.queries()[name](spark, folder), sql_result(folder, name))
    assert problem is None, problem


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_every_document_is_in_the_result(spark, folder, name):
    rows = entry_points.queries()[name](spark, folder).collect()
    assert len(rows) == N * WITHOUT_SQL[name] and {r["doc_id"] for r in rows} == set(range(N))
    assert all(v is not None for r in rows if r["doc_id"] in EMPTY for v in r)


@pytest.mark.parametrize("name", ["shap_long", "shap_swarm", "shap_global"])
def test_attributions_of_every_document(spark, folder, name):
    rows = entry_points.queries()[name](spark, folder).collect()
    if name == "shap_global":
        assert len(rows) == 5 and all(r["mean_abs_shap"] is not None for r in rows)
    else:
        assert {r["doc_id"] for r in rows} == set(range(N))


@pytest.mark.parametrize("name", SORTED_JOIN)
def test_labels_too_many_for_a_broadcast(spark, tmp_path, name):
    """The features are then made of all documents, not only of labelled ones."""
    folder = write_tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entry_points.queries()[name](spark, folder)
        if name in entry_points.oracle_sql():
            problem = compare(found, sql_result(folder, name))
            assert problem is None, problem
        else:
            assert found.count() == 1 and found.first()["n_documents"] == N
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
