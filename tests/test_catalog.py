"""Every catalogue query against its SQL twin on the smallest scale."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PLANS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    ok, note, _ = compare(spark, con, PLANS[name], SQL[name], SF)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(PLANS) - set(SQL)))
def test_rows_only(spark, name):
    assert PLANS[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "macd_signal" in df.columns
