from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    run, sql = driver.queries()[name], driver.oracle_sql()[name]
    assert oracle.differences(spark, con, run, sql, SF_DIR) == []


def test_entry_gives_rows(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and len(df.columns) == 23
