"""Every query against its SQL twin in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
