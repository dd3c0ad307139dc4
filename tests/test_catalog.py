"""Every registered query against its SQL on the smallest generated tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_file
from catalog import ORACLES, QUERIES
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no generated tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = entry_file.queries()[name](spark, FOLDER)
    expected = db.sql(entry_file.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = [tuple(r) for r in df.collect()]
    assert rows_of(df.columns, got) == rows_of(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
