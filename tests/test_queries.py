"""Every registered query beside its SQL on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
