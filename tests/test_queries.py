"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as contract
from tallywell.plans.oracle import ORACLE_SQL
from tallywell.plans.queries import QUERIES
from compare import difference, duck

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["region", "n", "mean", "sd", "top2", "bottom2"] and df.count() == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    df = contract.queries()[name](spark, FOLDER)
    assert difference(df, connection, contract.oracle_sql()[name]) is None


def test_pairs_of_phrases_search_the_comments_once(spark):
    df = contract.queries()["b14_co_occurrence_phrases"](spark, FOLDER)
    assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
