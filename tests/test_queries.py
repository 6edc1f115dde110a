"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
# Selective filters that can find nothing in so little data.
MAY_BE_EMPTY = {
    "T2", "T7", "T8", "T11", "T16", "T20", "T21", "X5_recent", "A10_having_subquery", "J11_points_in_intervals"
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    note = compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert note == "" or (note == "EMPTY" and name in MAY_BE_EMPTY)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
