"""Every registered query against its SQL text, value for value."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(spark, QUERIES[name], SQL[name], sf_dir, con) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_the_feature_columns(spark):
    assert len(entry.entry(spark).columns) == 118
