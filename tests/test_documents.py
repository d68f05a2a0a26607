import json
import random
from datetime import date, datetime

import pytest
from factories import bronze
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from tillstream.operators.dedup import dedup_latest
from tillstream.operators.documents import to_documents, upsert_kpis, with_doc_id
from tillstream.operators.ingest import parse_events, to_records
from tillstream.schemas import ORDERS
from tillstream.sources.topics import write_topic

SHELVES = "product_id string, product_name string, warehouse_id string, current_stock int"


def ids(df, kpi_type):
    return [r.id for r in with_doc_id(df, kpi_type).collect()]


def test_ids_name_every_key(spark):
    hour = spark.createDataFrame(
        [(datetime(2026, 1, 2, 3), "North America"), (datetime(2026, 1, 2, 3), None)],
        "hour_bucket timestamp, region string",
    )
    assert ids(hour, "hourly_revenue") == [
        "hourly_revenue_2026-01-02T03:00:00_North America",
        "hourly_revenue_2026-01-02T03:00:00_None",
    ]
    shelves = spark.createDataFrame([("SKU-1", "Lamp", f"WH-{n}", 1) for n in (1, 2)], SHELVES)
    assert ids(shelves, "inventory") == ["inventory_SKU-1_Lamp_WH-1", "inventory_SKU-1_Lamp_WH-2"]
    assert ids(spark.range(1).select(F.lit(1).alias("total_clicks")), "conversion") == ["conversion"]
    summary = spark.createDataFrame([("summary_20260102",)], "id string")
    assert ids(summary, "summary") == ["summary_20260102"]


def test_different_keys_have_different_ids(spark):
    parts = ["a", "a_b", "b", "_", "%", "%5F", "a%5Fb", "None", "%4Eone", None, ""]
    rows = [(x, y, z, 0) for x in parts for y in parts for z in parts]
    found = ids(spark.createDataFrame(rows, SHELVES), "inventory")
    assert len(set(found)) == len(rows)


def test_documents_hold_the_whole_row(spark):
    schema = (
        "hour_bucket timestamp, region string, revenue double, order_count long, "
        "computed_at timestamp, day date, product struct<id:string,tags:array<string>>, missing string"
    )
    moment = datetime(2026, 1, 2, 3, 4, 5, 120000)
    row = (datetime(2026, 1, 2, 3), "Europe", 12.5, 3, moment, date(2026, 1, 2), ("a", ["x"]), None)
    found = to_documents(spark.createDataFrame([row], schema), "hourly_revenue").first()
    assert (found.kpi_type, found.id) == ("hourly_revenue", "hourly_revenue_2026-01-02T03:00:00_Europe")
    assert json.loads(found.doc) == {
        "hour_bucket": "2026-01-02T03:00:00",
        "region": "Europe",
        "revenue": 12.5,
        "order_count": 3,
        "computed_at": moment.isoformat(),
        "day": "2026-01-02",
        "product": {"id": "a", "tags": ["x"]},
        "missing": None,
        "kpi_type": "hourly_revenue",
        "id": found.id,
    }


def test_upsert_equals_brute_force(spark):
    random.seed(3)
    schema = "kpi_type string, id string, value int, computed_at int"
    types, names = ["a", "b", None], [None, *map(str, range(60))]
    existing = {(t, n): (t, n, 0, 0) for t in types for n in names if random.random() < 0.5}
    updates = [(random.choice(types), random.choice(names), v, v % 97) for v in range(97)]
    merged = dict(existing)
    for row in sorted(updates, key=lambda r: r[3]):
        merged[row[:2]] = row
    found = upsert_kpis(
        spark.createDataFrame(list(existing.values()), schema), spark.createDataFrame(updates, schema)
    )
    def order(row):
        return str(tuple(row))

    assert sorted(map(tuple, found.collect()), key=order) == sorted(merged.values(), key=order)


def test_upsert_fills_columns_of_either_side(spark):
    old = spark.createDataFrame([("k", "1", 1), ("k", "2", 2)], "kpi_type string, id string, old int")
    new = spark.createDataFrame([("k", "2", 9)], "kpi_type string, id string, fresh int")
    rows = upsert_kpis(old, new).orderBy("id").collect()
    assert rows == [
        Row(kpi_type="k", id="1", old=1, fresh=None),
        Row(kpi_type="k", id="2", old=None, fresh=9),
    ]


def test_upsert_is_one_exchange_without_join(spark):
    schema = "kpi_type string, id string, computed_at int"
    a, b = (spark.createDataFrame([("k", "1", n)], schema) for n in (1, 2))
    plan = upsert_kpis(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_records_are_keyed_by_the_first_key_present(spark):
    rows = [("c1", "p1", 1), ("", "p2", 2), (None, "p3", 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "customer_id string, product_id string, n int")
    records = to_records(df, ("customer_id", "product_id")).select(
        F.col("key").cast("string"), F.col("value").cast("string")
    )
    keys, values = zip(*[tuple(r) for r in records.collect()])
    assert keys == ("c1", "p2", "p3", None)
    assert json.loads(values[2]) == {"customer_id": None, "product_id": "p3", "n": 3}


def test_published_records_read_back_as_events(spark, tmp_path):
    events = bronze(spark, "orders", {}, {"total_amount": 1.5}).select(*ORDERS.schema.names)
    path = str(tmp_path / "orders")
    for _ in range(2):
        write_topic(to_records(events, ORDERS.key_columns), "orders", "parquet", path)
    stored = spark.read.parquet(path)
    assert stored.select(F.col("key").cast("string"), "topic").distinct().collect() == [
        Row(key="CUST-1", topic="orders")
    ]
    source = {"partition": F.lit(0), "offset": F.lit(1), "timestamp": F.current_timestamp()}
    decoded = parse_events(stored.withColumns(source), ORDERS).select(*events.columns)
    assert decoded.count() == 4
    assert decoded.distinct().exceptAll(events).count() == 0
    assert events.exceptAll(decoded).count() == 0


def test_latest_needs_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        dedup_latest(spark.range(3), "id")
