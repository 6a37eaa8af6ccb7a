"""Every registered query against its SQL, over whole tables."""

import os

import compare
import pytest

import __spark_entry__ as contract
from kilnmark.suite.oracle import ORACLE
from kilnmark.suite.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    """Optional parts may add queries without a form in SQL; their own tests compare those with brute force."""
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert compare.differences(frame, con, contract.oracle_sql()[name]) == []


def test_sorted_answers_come_sorted(spark):
    queries = contract.queries()
    keys = [r["key"] for r in queries["range_scan_past_24h"](spark, SF_DIR).collect()]
    assert keys == sorted(keys) and keys
    xs = [r["x"] for r in queries["running_series"](spark, SF_DIR).collect()]
    assert xs == sorted(xs, reverse=True) and xs
    times = [r["datetime"] for r in queries["chronological_export"](spark, SF_DIR).collect()]
    assert times == sorted(times) and times


def test_entry(spark):
    frame = contract.entry(spark)
    assert "key" in frame.columns and frame.count() > 0
