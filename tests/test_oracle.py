"""Every query with SQL must equal DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, con, name):
    problem = difference(spark, con, sf_dir, queries()[name], SQL[name])
    assert problem is None or (problem == "no rows" and name == "min_packets"), problem


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert "flow_duration" in df.columns
    assert df.count() > 0
