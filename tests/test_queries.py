"""Every registered query with SQL gives the same rows, types and values in both engines."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_file
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.schema == entry_file.entry(spark).schema and df.count() > 0
