"""Silver rows and hours from streams, against the batch."""

import random

import pytest
from factories import bronze
from pyspark.sql import functions as F

from tillstream.operators import kpis as K
from tillstream.operators.cleaning import clean_orders
from tillstream.plans.gold import load_kpis
from tillstream.schemas import ORDERS
from tillstream.streaming import live

NOW = {"availableNow": True}
FLUSH = {"event_id": "Z", "timestamp": "2026-03-01T00:00:00Z"}


def send(spark, folder, *changes):
    bronze(spark, "orders", *changes).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run_silver(spark, tmp_path):
    rows = stream(spark, str(tmp_path / "in"), ORDERS.bronze_schema)
    silver = live.silver_stream(rows, ORDERS, "1 hour")
    query = live.start_silver(silver, ORDERS, str(tmp_path), str(tmp_path / "ck"), NOW)
    query.awaitTermination()
    return query


def stored(spark, tmp_path):
    return spark.read.parquet(live.live_path(str(tmp_path), "orders")).drop("event_date")


def contents(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_stream_equals_batch_silver_with_a_restart(spark, tmp_path):
    rng, folder = random.Random(3), str(tmp_path / "in")

    def copies(hour, count=40):
        return [
            {
                "event_id": rng.choice([f"E{hour}-{k}" for k in range(12)] + [None]),
                "timestamp": f"2026-01-02T{hour:02d}:{rng.randrange(30):02d}:00Z",
                "status": rng.choice(["completed", " PENDING", "failed"]),
                "total_amount": rng.choice([5.0, 0.0, 9.5]),
                "kafka_offset": rng.randrange(10**6),
            }
            for _ in range(count)
        ]

    for hour in (1, 2):
        send(spark, folder, *copies(hour))
    run_silver(spark, tmp_path)
    # After a restart the copies seen before are still known.
    send(spark, folder, *copies(2))
    send(spark, folder, *copies(3))
    run_silver(spark, tmp_path)
    send(spark, folder, FLUSH)
    run_silver(spark, tmp_path)

    found = stored(spark, tmp_path)
    sent = spark.read.schema(ORDERS.bronze_schema).parquet(folder).filter("event_id <> 'Z'")
    silver, _ = clean_orders(sent)
    columns = [c for c in found.columns if c != "copies"]
    assert contents(found, columns) == contents(silver, columns)
    valid = sent.filter("event_id is not null and total_amount > 0").count()
    assert found.agg(F.sum("copies")).first()[0] == valid > found.count()


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = str(tmp_path / "in")
    send(spark, folder, {"event_id": "A", "timestamp": "2026-01-02T09:00:00Z"})
    send(spark, folder, {"event_id": "B", "timestamp": "2026-01-02T08:30:00Z"})  # within the hour
    send(spark, folder, {"event_id": "C", "timestamp": "2026-01-02T01:00:00Z"})
    send(spark, folder, {"event_id": "D", "timestamp": "no time"}, FLUSH)
    counts = live.stream_counts(run_silver(spark, tmp_path))
    assert counts["late_rows"] == 1
    assert sorted(r.event_id for r in stored(spark, tmp_path).collect()) == ["A", "B"]


def test_latest_copies_of_a_table_and_without_order(spark):
    rows = bronze(spark, "orders", *[{"event_id": "A", "kafka_offset": k, "total_amount": float(k)} for k in (3, 9, 5)])
    rows = rows.withColumn("event_ts", F.to_timestamp("timestamp"))
    found = live.latest_copies(rows).collect()
    assert [(r.total_amount, r.copies) for r in found] == [(9.0, 3)]
    with pytest.raises(ValueError, match="order"):
        live.latest_copies(rows, order=["no_such_column"])


def run_hours(spark, tmp_path, folder, schema):
    orders = stream(spark, folder, schema)
    query = live.start_hourly_revenue(orders, str(tmp_path), str(tmp_path / "hours"), "2 hours", NOW)
    query.awaitTermination()
    return query


def hours(df):
    columns = [c for c in df.columns if c not in ("computed_at", "id")]
    return contents(df, sorted(columns))


def test_hours_are_corrected_by_late_orders_and_replays_change_nothing(spark, tmp_path):
    folder = str(tmp_path / "silver")

    def orders(*changes):
        clean_orders(bronze(spark, "orders", *changes))[0].coalesce(1).write.mode("append").parquet(folder)

    def order(n, at, amount, region="Europe"):
        return {"event_id": f"E{n}", "timestamp": f"2026-01-02T{at}:00Z", "total_amount": amount,
                "customer_id": f"c{n % 3}", "region": region}

    orders(order(1, "05:10", 10.0), order(2, "05:20", 1.5), order(3, "06:10", 4.0, "Asia"))
    schema = spark.read.parquet(folder).schema
    run_hours(spark, tmp_path, folder, schema)
    orders(order(4, "06:50", 3.0))
    orders(order(5, "05:40", 100.0))  # late, but within two hours
    orders(order(6, "23:00", 1.0))
    orders(order(8, "23:10", 2.0))  # Spark holds rows against the watermark of the batch before
    orders(order(7, "05:50", 5000.0))  # too late
    run_hours(spark, tmp_path, folder, schema)
    base = str(tmp_path)
    kept = spark.read.parquet(folder).filter("event_id <> 'E7'")
    batch = K.hourly_revenue(kept, estimate_customers=True)
    found = load_kpis(spark, base, kpi_types=["hourly_revenue"])["hourly_revenue"]
    assert hours(found) == hours(batch) and found.count() == 4

    # The last batch once more: its number is known, so nothing is written.
    versions = sorted(p.name for p in (tmp_path / "kpis/hourly_revenue").glob("v*"))
    last = live.last_batch(spark, base, "hourly_revenue", "hourly_revenue")
    assert last >= 3
    live.kpi_sink(base, "hourly_revenue", "hourly_revenue")(batch.limit(1), last)
    assert versions == sorted(p.name for p in (tmp_path / "kpis/hourly_revenue").glob("v*"))
    # A batch that broke off before its number was noted is upserted again: totals stay.
    live.kpi_sink(base, "hourly_revenue", "hourly_revenue")(batch, last + 1)
    again = load_kpis(spark, base, kpi_types=["hourly_revenue"])["hourly_revenue"]
    assert hours(again) == hours(batch)
    assert live.last_batch(spark, base, "hourly_revenue", "other") == -1


def test_old_versions_of_a_stream_go(spark, tmp_path):
    """A batch a minute must not leave a table a minute."""
    base = str(tmp_path)
    silver, _ = clean_orders(bronze(spark, "orders", {"event_id": "A", "total_amount": 7.0}))
    rows = K.hourly_revenue(silver, estimate_customers=True)
    sink = live.kpi_sink(base, "hourly_revenue", "s", keep=2)
    for batch in range(4):
        sink(rows, batch)
    assert len(list((tmp_path / "kpis/hourly_revenue").glob("v[0-9]*"))) == 2
    found = load_kpis(spark, base, kpi_types=["hourly_revenue"])["hourly_revenue"]
    assert [r.revenue for r in found.collect()] == [7.0]
    live.kpi_sink(base, "hourly_revenue", "s", keep=None)(rows, 4)
    assert len(list((tmp_path / "kpis/hourly_revenue").glob("v[0-9]*"))) == 3
