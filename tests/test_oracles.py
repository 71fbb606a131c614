"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
import oracles
from compare import assert_same, database
from conftest import TESTDATA

SF = os.environ.get("TEST_SF", "0.01")
FOLDER = f"{TESTDATA}/sf{SF}"
QUERIES = entry.shop_queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert assert_same(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) > 0


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["product_category", "revenue_in_lakhs"]
    assert frame.count() > 0
