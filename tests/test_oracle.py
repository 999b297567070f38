"""Every registered query against its reference SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle_check import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert "oee" in df.columns and not df.isEmpty()
