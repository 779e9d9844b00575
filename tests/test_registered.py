"""Every registered query against its SQL in DuckDB, and the driver's contract."""

import os

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, connect
from conftest import rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry_points.library_queries()))
def test_query_equals_its_sql(spark, con, name):
    difference, _, _ = compare(spark, con, name, SF_DIR)
    assert difference is None


def test_contract(spark):
    assert set(entry_points.library_queries()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert rows(entry_points.entry(spark))
