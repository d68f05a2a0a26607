"""Registered text queries over whole given tables, against their SQL where it exists."""

import duckdb
import pytest

import __spark_entry__ as registry
from tillstream.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "labels")
# What each query returns per row of its table.
ROWS_OF = {name: "pages" if name[:4] in ("op5_", "op9_") else "documents" for name in Q.QUERIES}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def test_one_query_per_operator_is_registered():
    registered = registry.queries()
    assert set(Q.QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
    assert set(Q.SQL) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, database, name):
    df = Q.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted(tuple(comparable(row[c]) for c in columns) for row in df.collect())
    cursor = database.execute(Q.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = sorted(
        tuple(comparable(row[names.index(c)]) for c in columns) for row in cursor.fetchall()
    )
    assert found == wanted and found


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_covers_its_whole_table(spark, database, name):
    df = Q.QUERIES[name](spark, SF_DIR)
    key = "page_id" if "page_id" in df.columns else "doc_id"
    found = sorted(r[0] for r in df.select(key).collect())
    wanted = database.execute(f"select {key} from {ROWS_OF[name]} order by 1").fetchall()
    assert found == [r[0] for r in wanted]
