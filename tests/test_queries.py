"""Every registered query against its SQL, and the driver contract."""

import glob

import pytest

import __spark_entry__ as entry
from graphweft.plans import ORACLE, QUERIES
from graphweft.plans.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not glob.glob(f"{SF}/*.parquet"):
        pytest.skip("no test data here")
    return connect(SF)


def test_contract(spark, con):
    assert entry.queries().keys() >= QUERIES.keys()  # an optional subpackage may add its own
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["region", "customer", "orders", "total"] and df.count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, con, name):
    line = compare(spark, con, name, SF)
    assert line.startswith(("ok", "rows") if name in ORACLE else "rows"), line
