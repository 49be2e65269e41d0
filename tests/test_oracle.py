"""Every query with SQL gives DuckDB's rows; the others run and keep their schema."""

import pytest
from oracle import connect, difference

import __spark_entry__ as driver
from parityloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_equals_sql(spark, con, name):
    assert difference(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).head(1)


def test_entry(spark):
    got = driver.entry(spark)
    assert got.columns == ["l1", "tv", "max_error", "js"] and got.count() == 1
    assert set(driver.oracle_sql()) <= set(driver.queries())
