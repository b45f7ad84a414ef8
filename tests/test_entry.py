"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle import connect, differences
from tradeloom.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not mounted")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_registry_is_complete():
    # All of this library's queries have SQL. Those of the text operators need not; they have tests of their own.
    assert set(ORACLE) == set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns[0] == "order_id"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(entry_points.queries()[name](spark, FOLDER), con, entry_points.oracle_sql()[name]) == []
