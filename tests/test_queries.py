"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from curveloom.checks.registry import QUERIES
from tests.oracle import TESTDATA, connect, differences

pytestmark = pytest.mark.skipif(not (TESTDATA / "sf0.001").exists(), reason="driver tables not present")
# on the smallest tables these may rightly be empty
MAY_BE_EMPTY = {"search", "search_single", "slice_tables"}


@pytest.fixture(scope="module")
def con():
    return connect("0.001")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    problems = differences(spark, con, name, "0.001")
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows"]
    assert not problems


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["damage_type", "x", "y_mean", "y_std", "y_min", "y_max", "n_at_x"]
