"""The driver's view: every query has its SQL, and both give the same columns, types and rows."""

import pytest

import __spark_entry__ as driver
from tidemark_driver.oracles import SQL
from tidemark_driver.queries import QUERIES
from tests.oracle import TESTDATA, compare, connect

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_gives_rows(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["ds", "window_start", "window_end"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    rows, difference = compare(driver.queries()[name](spark, f"{TESTDATA}/{SF}"), con, driver.oracle_sql()[name])
    assert difference is None
    assert rows > 0
