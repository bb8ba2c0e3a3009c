"""Every query without a model fit is compared with its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.check_oracles import compare, views_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
SLOW = {"lr_gradient", "oof_coverage", "shap_additivity", "stream_parity", "reload_parity"}


@pytest.fixture(scope="module")
def con():
    return views_of(duckdb.connect(), FOLDER)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 99


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(set(entry_points.oracle_sql()) - SLOW))
def test_query_matches_sql(spark, con, name):
    got = entry_points.queries()[name](spark, FOLDER)
    problem = compare(got, con.execute(entry_points.oracle_sql()[name]))
    assert problem is None, problem


def test_model_registry_reads_the_given_tables(spark, con):
    query = entry_points.queries()["model_registry"]
    assert query(spark, FOLDER).count() == 1
    # The bundle is saved by now; the counts still come from the tables.
    row = query(spark, FOLDER).first()
    want = con.execute("""SELECT count(*), count(quality), count(*) FILTER (quality = 0), count(*) FILTER (quality = 1)
        FROM documents LEFT JOIN labels USING (doc_id)""").fetchone()
    assert tuple(row[c] for c in ("n_documents", "n_labelled", "n_class_0", "n_class_1")) == want
