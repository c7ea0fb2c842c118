"""Every registered query against DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import differences, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", contract.queries())
def test_query(name, spark, con):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert not df.isEmpty()
    else:
        assert differences(df, con, sql) is None


def test_oracle_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
