"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
from compare import compare, connect

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 6
    assert rows == sorted(rows, key=lambda r: -r.failure_rate_pct)
