"""Every query of the subpackage with an SQL text against it, and plain versions for edge cases."""

import pytest

from tests.oracle import connect, duck_rows, spark_rows
from tripmart.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows, "the supplied tables hold cases"
    assert rows == expected
