"""Every registered query with an SQL counterpart gives the same names, types and values."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences

SQL = oracle_sql()


@pytest.fixture(scope="module")
def tables(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, tables, name):
    assert differences(queries()[name](spark, small), tables, SQL[name]) == []


def test_every_check_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 10
