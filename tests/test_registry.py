"""Every registered query against its SQL, row by row, on the given tables."""

import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registry
from testbed.events import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.core_queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        return repr(float(value))
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted(tuple(comparable(row[c]) for c in columns) for row in df.collect())
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    wanted = sorted(tuple(comparable(row[i]) for i in places) for row in cursor.fetchall())
    assert found == wanted
    assert found, "the query has no rows to compare"


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns
