"""Each registered query against its SQL in DuckDB, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "customer", "nation", "region")
# What is registered without the optional parts, which have tests of their own.
QUERIES = entry_module.QUERIES
ORACLE = entry_module.ORACLE


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{SF_DIR}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    found = [tuple(row) for row in frame.select(*columns).collect()]
    result = database.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert found


def test_entry(spark):
    assert entry_module.entry(spark).count() == 10
