"""Every registered query against its SQL, on the smallest driver tables."""

import pytest

import __spark_entry__ as driver
from checks.oracles import ORACLES
from checks.queries import QUERIES
from compare import database, differences

DATA = driver.SMOKE_DATA


@pytest.fixture(scope="module")
def db():
    with database(DATA) as connection:
        yield connection


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "order_year", "category", "sub_category", "customer_id", "total_profit",
    ]


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, db, name):
    frame = QUERIES[name](spark, DATA)
    assert differences(frame, db, ORACLES[name]) == []
