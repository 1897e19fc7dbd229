"""Every registered query gives the rows of its SQL twin."""

import os

import pytest

import compare
from skylattice.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_DIR = "/root/testdata/sf0.001"

ROWS_ONLY = [name for name in QUERIES if name not in ORACLES]


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SMALL_DIR)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry_has_rows(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
