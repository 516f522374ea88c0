"""Every registered query against its SQL counterpart, or for rows without one."""

import pytest

import __spark_entry__ as entry
from fleetlens.plans import load_catalog
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"
QUERIES, SQL = load_catalog().QUERIES, load_catalog().SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in SQL:
        assert df.count() > 0
        return
    assert compare(df, con, SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_contract_names():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
