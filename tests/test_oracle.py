"""Every registered query against its SQL on the same tables."""

import pytest
from compare import difference, open_tables

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


def test_every_sql_text_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, tables, name):
    assert difference(QUERIES[name](spark, SF), tables, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
