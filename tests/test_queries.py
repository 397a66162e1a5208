"""Registered queries against their SQL on the smallest data."""

import pytest
from oracle import connect, difference, spark_rows, sql_rows

import __spark_entry__ as entry
from ledgerlift.workloads.registry import QUERIES

SF = "/root/testdata/sf0.001"
# one job and its products serve all queries of a session, so every query is run here
WITHOUT_SQL = {"D12_connected_components"}
NAMES = [n for n in QUERIES if n not in WITHOUT_SQL]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, con, name):
    assert difference(spark_rows(entry.queries()[name](spark, SF)), sql_rows(con, entry.oracle_sql()[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) - WITHOUT_SQL <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 4
