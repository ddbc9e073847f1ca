"""Every registered query against its SQL, and the driver's entry points."""

import os
import re

import pytest

import __spark_entry__ as spark_entry
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The queries of the llm subpackage have tests of their own.
QUERIES = {
    name: build
    for name, build in spark_entry.queries().items()
    if not re.match(r"op\d+_|pipeline$", name)
}
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, connection):
    names, rows = compare.rows_of_spark(QUERIES[name](spark, SF_DIR))
    assert rows
    if name in ORACLES:
        sql_names, sql_rows = compare.rows_of_duckdb(connection, ORACLES[name])
        assert names == sql_names
        assert compare.difference(rows, sql_rows) is None


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["model", "cases", "category_accuracy"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(spark_entry.queries())
