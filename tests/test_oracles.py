"""Every query against its SQL meaning."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches(name, spark, sf, con):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) is None


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
