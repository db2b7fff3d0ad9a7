"""Every registered query that has SQL, against DuckDB at the smallest scale."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# At this scale nothing qualifies; the larger scales have rows.
EMPTY = {"sigma_episodes", "point_lookup", "stream_episodes_sliding"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF, con)
    assert got is None or (got == "empty" and name in EMPTY), got


def test_entry(spark):
    assert entry.entry(spark).count() == 14


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
