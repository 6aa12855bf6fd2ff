"""Every registered query against its SQL on the same tables."""

import os

import pytest

import __spark_entry__ as contract
from strataflow.queries import ORACLES, QUERIES
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(db, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows or name.startswith("freshness_exists")


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
