"""Gold from the dates that changed, against gold from all of silver."""

import random
from datetime import datetime, timedelta, timezone

from factories import bronze
from pyspark.sql import functions as F
from test_incremental import FIRST
from test_lookup import leaves

from tillstream import __main__ as job
from tillstream.operators.lookup import in_partitions
from tillstream.plans import refresh as P
from tillstream.plans.changes import changes_noted
from tillstream.plans.gold import build_kpis, load_kpis
from tillstream.plans.silver import process_silver
from tillstream.schemas import EVENT_TYPES
from tillstream.sources.tables import layer_path, read_layer

AS_OF = datetime(2026, 2, 1, tzinfo=timezone.utc)


def arrive(spark, base, event_type, day, *changes):
    rows = bronze(spark, event_type, *changes).withColumn("arrival_date", F.lit(FIRST + timedelta(days=day)))
    path = layer_path(base, "bronze", event_type)
    rows.coalesce(1).write.mode("append").partitionBy("arrival_date").parquet(path)


def some(rng, event_type, count):
    times = ["2026-01-02T03:10:00Z", "2026-01-02T04:10:00Z", "2026-01-03T05:00:00Z", "2026-01-09T00:00:00Z", None]
    for _ in range(count):
        row = {
            "event_id": f"E{rng.randrange(30)}",
            "timestamp": rng.choice(times),
            "kafka_offset": rng.randrange(10**6),
            "kafka_partition": rng.randrange(3),
        }
        if event_type == "orders":
            row |= {
                "status": rng.choice(["completed", "completed", "failed"]),
                "total_amount": rng.choice([5.005, 7.25, float("nan"), 30.0]),
                "customer_id": f"c{rng.randrange(6)}",
                "region": rng.choice(["Europe", "Asia"]),
                "product": (f"P{rng.randrange(4)}", "x", "y", 1.0),
            }
        elif event_type == "clicks":
            row |= {"added_to_cart": rng.choice([True, False, None])}
        else:
            row |= {
                "product_id": f"P{rng.randrange(4)}",
                "stock_level": rng.randrange(200),
                "reorder_threshold": rng.choice([None, 40, 80]),
                "low_stock_alert": rng.choice([True, False]),
            }
        yield row


def contents(df):
    return sorted(map(repr, df.select(sorted(set(df.columns) - {"id"})).collect()))


def assert_equals_full_gold(spark, base):
    silver = [read_layer(spark, base, "silver", n) for n in EVENT_TYPES]
    stored = load_kpis(spark, base)
    for kpi_type, kpi in build_kpis(*silver, as_of=AS_OF).items():
        gold = read_layer(spark, base, "gold", kpi_type)
        assert contents(gold) == contents(kpi), kpi_type
        if kpi_type != "hourly_revenue":  # stored hours stay when their orders are gone
            assert contents(stored[kpi_type]) == contents(kpi), kpi_type


def test_refreshed_gold_equals_a_full_run(spark, tmp_path):
    base, rng = str(tmp_path), random.Random(8)
    for day in range(2):
        for name in EVENT_TYPES:
            # Later runs change a few events only, which may move or leave their date.
            arrive(spark, base, name, day, *some(rng, name, 40 if day == 0 else 6))
            process_silver(spark, base, name)
        P.refresh_gold(spark, base, as_of=AS_OF)
    assert_equals_full_gold(spark, base)
    # After a rebuild all parts of the type are made again.
    process_silver(spark, base, "orders", rebuild=True)
    assert P.refresh_parts(spark, base, "orders") and not P.refresh_parts(spark, base, "orders")


def test_only_changed_dates_are_made_again(spark, tmp_path):
    base = str(tmp_path)
    for name in EVENT_TYPES:
        days = [{"event_id": f"E{d}", "timestamp": f"2026-01-{d:02d}T01:00:00Z"} for d in range(1, 9)]
        arrive(spark, base, name, 0, *days)
        process_silver(spark, base, name)
    P.refresh_gold(spark, base, as_of=AS_OF)
    parts = tmp_path / "gold_parts/order_days"
    before = {p.name: p.stat().st_mtime_ns for p in parts.glob("event_date=*")}
    assert len(before) == 8
    # One order moves from the third to the fifth, so the third is left without any.
    arrive(spark, base, "orders", 1, {"event_id": "E3", "kafka_offset": 9, "timestamp": "2026-01-05T01:00:00Z"})
    process_silver(spark, base, "orders")
    dates = changes_noted(spark, base, "orders").filter("not whole").select("event_date")
    assert sorted(str(r.event_date) for r in dates.collect()) == ["2026-01-03", "2026-01-05"]
    silver = read_layer(spark, base, "silver", "orders")
    read = in_partitions(silver, dates, ["event_date"])
    assert read.count() == 2
    scans = [n for n in leaves(read._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan")]
    assert scans and "dynamicpruning" in read._jdf.queryExecution().toString()
    P.refresh_gold(spark, base, as_of=AS_OF)
    after = {p.name: p.stat().st_mtime_ns for p in parts.glob("event_date=*")}
    assert {n for n in after if after[n] != before[n]} == {"event_date=2026-01-03", "event_date=2026-01-05"}
    assert_equals_full_gold(spark, base)
    assert not P.refresh_parts(spark, base, "orders")


def test_gold_job_of_changed_dates(spark, tmp_path):
    base = str(tmp_path)
    for name in EVENT_TYPES:
        arrive(spark, base, name, 0, {"event_id": "A"})
        process_silver(spark, base, name)
    job.main(["gold", "--base", base, "--changed", "--keep", "1"])
    assert read_layer(spark, base, "gold", "summary").first().total_orders == 1
