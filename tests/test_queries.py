"""Every registered query against its SQL, on the smallest tables."""

import re
import sys
from dataclasses import replace

import pytest
from compare import assert_same, connect

import __spark_entry__ as contract
from silverlode import JSON_TABLES, normalize
from silverlode.testing import fixtures


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert contract.table_queries().keys() == contract.table_sql().keys()


@pytest.mark.parametrize("name", contract.table_queries())
def test_query(spark, con, sf_dir, name):
    assert assert_same(contract.table_queries()[name](spark, sf_dir), con, contract.table_sql()[name]) > 0


def test_unnesting_keeps_null_numbers(spark, con, sf_dir):
    rows = normalize(fixtures.bronze(spark, sf_dir, "movies"), replace(JSON_TABLES["genre"], fill={}))
    assert assert_same(rows, con, fixtures.elements_sql("genre", fill=False)) > 0
    assert rows.where("id is null").count() > 0


def test_every_silver_table_of_the_pipeline(spark, con, sf_dir):
    """From CSV files through Bronze, each Silver table is what the parent rows say."""
    for name, df in contract._pipeline(spark, sf_dir).items():
        sql = fixtures.movies_sql("movie_id") if name == "movies" else fixtures.elements_sql(name)
        assert assert_same(df, con, sql) > 0


def test_inputs_are_built_by_several_tasks(spark, sf_dir):
    """However few splits a table of parent rows has, its documents are not one task's work."""
    files = fixtures.bronze(spark, sf_dir, "credits").inputFiles()
    assert len({re.search(r"/part-([0-9]+)", f)[1] for f in files}) > 2


def test_a_digest_tells_rows_apart(spark):
    """Order does not matter; a changed value, a row more or an exchange between columns does."""
    def digest(*rows):
        return tuple(fixtures.digest_of(spark.createDataFrame(rows, "a string, b string, x double"), "t").first())

    rows = [("a", "b", 1.5), (None, "~", None), ("a", "b", 1.5)]
    assert digest(*rows) == digest(*rows[::-1])
    others = [rows[:2], [("b", "a", 1.5), *rows[1:]], [("a", "b", 1.25), *rows[1:]], [("a", "b", 1.5), ("~", None, 1.0), rows[0]]]
    assert len({digest(*rows), *(digest(*o) for o in others)}) == 5


@pytest.mark.parametrize("missing", ["xxhash", "silverlode.llm.queries", "corpus_pipeline"])
def test_table_queries_stay_without_the_llm_package(monkeypatch, missing):
    """A module or a dependency that cannot be imported takes no other query with it."""
    for name in [m for m in sys.modules if m.startswith("silverlode.llm") or m == "corpus_pipeline" or m == missing]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert contract.queries().keys() == contract.table_queries().keys()
    assert contract.oracle_sql().keys() == contract.table_sql().keys()


def test_entry(spark, sf_dir):
    df = contract.entry(spark)
    assert df.columns == ["movie_id", "title", "id", "name", "department", "job", "credit_id"]
    assert df.count() > 0
