"""Every registered query against its SQL in another engine, and the comparison itself."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from oracle.compare import connect, differences

# Queries of the corpus subpackage have tests of their own.
QUERIES = {n: q for n, q in queries().items() if not q.__module__.startswith(("layercake.llm", "corpus_pipeline"))}
SQL = {n: sql for n, sql in oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    rows, notes = differences(spark, duck, SMALL, QUERIES[name], SQL[name])
    assert rows > 0 and not notes


def test_comparison_sees_a_difference(spark, duck):
    wrong = SQL["recency_90d"].replace("INTERVAL 90 DAY", "INTERVAL 30 DAY")
    assert wrong != SQL["recency_90d"]
    assert differences(spark, duck, SMALL, QUERIES["recency_90d"], wrong)[1]


def test_entry(spark):
    assert entry(spark).count() > 0
