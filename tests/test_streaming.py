import json
import math
from datetime import datetime

import pytest
from factories import DEFAULTS
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillstream.operators import kpis as K
from tillstream.operators.cleaning import clean_orders
from tillstream.operators.ingest import to_bronze
from tillstream.schemas import EVENT_TYPES, ORDERS, TOPIC_SCHEMA
from tillstream.sources.tables import read_layer
from tillstream.sources.topics import read_topic
from tillstream.streaming.bronze import await_all, start_bronze

NOW = {"availableNow": True}
SENT = datetime(2026, 1, 2, 3, 4, 6)


def event(event_type, **changes):
    row = {**DEFAULTS[event_type], **changes}
    if event_type == "orders":
        row["product"] = dict(zip(("id", "name", "category", "unit_price"), row["product"]))
    return json.dumps(row)


def publish(spark, folder, topic, values, first=0):
    rows = [
        (None, v.encode() if v is not None else None, topic, n % 3, first + n, SENT)
        for n, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, TOPIC_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{topic}")


def ingest(spark, tmp_path, **options):
    queries = start_bronze(
        spark,
        str(tmp_path / "tables"),
        str(tmp_path / "checkpoints"),
        source_fmt="parquet",
        source_base=str(tmp_path / "topics"),
        trigger=NOW,
        **options,
    )
    await_all(spark, queries)


def bronze(spark, tmp_path, name):
    return read_layer(spark, str(tmp_path / "tables"), "bronze", name)


def test_stream_equals_batch_and_restart_adds_only_new(spark, tmp_path):
    topics = str(tmp_path / "topics")
    for name in EVENT_TYPES:
        publish(spark, topics, name, [event(name, event_id=f"E{n}") for n in range(20)])
    ingest(spark, tmp_path)
    for name, spec in EVENT_TYPES.items():
        stored = bronze(spark, tmp_path, name)
        records = spark.read.schema(TOPIC_SCHEMA).parquet(f"{topics}/{name}")
        assert stored.filter("arrival_date = to_date(ingested_at)").count() == 20
        streamed = stored.drop("ingested_at", "arrival_date")
        batch = to_bronze(records, spec).select(streamed.columns)
        assert streamed.count() == 20
        assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
        assert stored.filter("ingested_at is null").count() == 0

    ingest(spark, tmp_path)
    publish(spark, topics, "orders", [event("orders", event_id="NEW")], first=20)
    ingest(spark, tmp_path)
    offsets = [r[0] for r in bronze(spark, tmp_path, "orders").select("kafka_offset").collect()]
    assert sorted(offsets) == list(range(21))
    assert bronze(spark, tmp_path, "clicks").count() == 20


def test_bad_records_are_kept(spark, tmp_path):
    """What cannot be decoded is NULL; what arrived is still there."""
    values = [
        "not json",
        "[1]",
        None,
        event("orders", total_amount="many", quantity=2**40, extra=1, order_id=17),
        event("orders", total_amount=math.nan),
    ]
    publish(spark, str(tmp_path / "topics"), "orders", values)
    ingest(spark, tmp_path, event_types=["orders"])
    rows = bronze(spark, tmp_path, "orders").orderBy("kafka_offset").collect()
    assert [r._raw for r in rows] == values
    assert [r.event_id for r in rows] == [None, None, None, "EVT-001", "EVT-001"]
    assert (rows[3].total_amount, rows[3].quantity, rows[3].order_id) == (None, None, "17")
    assert math.isnan(rows[4].total_amount)
    silver, rejected = clean_orders(bronze(spark, tmp_path, "orders"))
    assert (silver.count(), rejected.count()) == (1, 4)


def test_columns_added_later_are_null_in_older_files(spark, tmp_path):
    older = spark.createDataFrame([("E1", 1)], "event_id string, kafka_offset long")
    older.write.parquet(str(tmp_path / "tables/bronze/orders"))
    row = bronze(spark, tmp_path, "orders").first()
    assert (row.event_id, row.total_amount, row.product) == ("E1", None, None)


def test_a_failed_stream_is_reported_and_the_others_stop(spark, tmp_path):
    topics = str(tmp_path / "topics")
    publish(spark, topics, "orders", [event("orders")])
    source = {"fmt": "parquet", "path": f"{topics}/orders"}
    healthy = read_topic(spark, "orders", **source)
    broken = read_topic(spark, "orders", **source).select(F.raise_error(F.lit("boom")))

    def start(name, df):
        checkpoint = str(tmp_path / f"{name}_checkpoint")
        writer = df.writeStream.format("noop").option("checkpointLocation", checkpoint)
        return writer.trigger(processingTime="1 second").start()

    queries = [start("healthy", healthy), start("broken", broken)]
    with pytest.raises(StreamingQueryException, match="boom"):
        await_all(spark, queries)
    assert not any(q.isActive for q in queries)


def test_hourly_revenue_on_a_stream(spark, tmp_path):
    """The same KPI function; customers are estimated where rows arrive one by one."""
    events = [event("orders", event_id=f"E{n}", customer_id=f"C{n % 4}") for n in range(12)]
    publish(spark, str(tmp_path / "topics"), "orders", events)
    records = read_topic(spark, "orders", "parquet", str(tmp_path / "topics/orders"))
    orders = to_bronze(records, ORDERS).withColumn("event_ts", F.to_timestamp("timestamp"))
    query = (
        K.hourly_revenue(orders, estimate_customers=True)
        .writeStream.format("memory")
        .queryName("hourly")
        .outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    row = spark.table("hourly").first()
    assert (row.revenue, row.order_count, row.unique_customers) == (600.0, 12, 4)
