"""Every registered query against its SQL in DuckDB, on the smallest data set."""

import os
import sys

import pytest
from oracle_check import connect, compare

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert len(df.columns) > 0 and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
