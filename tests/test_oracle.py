"""Every query against its SQL text on the smallest supplied tables."""

import os

import pytest

import __spark_entry__ as entry_point

from .oracle import connect, duck_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
