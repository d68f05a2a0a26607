"""Silver runs that read only new arrival dates, against a recompute of everything."""

import logging
import random
import sys
from datetime import date, datetime, timedelta

import pytest
from factories import bronze
from pyspark.sql import functions as F

from tillstream import __main__ as job
from tillstream.operators.cleaning import CLEANERS
from tillstream.operators.dedup import ARRIVAL_ORDER
from tillstream.plans import silver as S
from tillstream.plans.silver import process_silver
from tillstream.sources.tables import layer_path, read_layer, read_quarantine

FIRST = date(2026, 1, 1)


def arrive(spark, base, day, *changes, mode="append"):
    rows = bronze(spark, "orders", *changes).withColumn(
        "arrival_date", F.lit(FIRST + timedelta(days=day))
    )
    path = layer_path(base, "bronze", "orders")
    rows.coalesce(1).write.mode(mode).partitionBy("arrival_date").parquet(path)


def contents(df):
    columns = sorted(set(df.columns) - {"silver_processed_at", "arrival_date", "failed_rules"})
    return sorted(map(repr, df.select(*columns).collect()))


def assert_equals_recompute(spark, base, **options):
    silver, rejected = CLEANERS["orders"](
        read_layer(spark, base, "bronze", "orders").drop("arrival_date"), **options
    )
    silver = silver.withColumn("event_date", F.to_date("event_ts"))
    assert contents(read_layer(spark, base, "silver", "orders")) == contents(silver)
    assert contents(read_quarantine(spark, base, "orders")) == contents(rejected)


def copies(rng, day, count):
    """Copies of a few ids whose status, date and order vary from one to the next."""
    return [
        {
            "event_id": rng.choice([None, *[f"E{k}" for k in range(40)]]),
            "status": rng.choice(["completed", "pending ", "FAILED", None]),
            "timestamp": rng.choice(["2026-01-01T05:00:00Z", "2026-01-02T05:00:00Z", "12:30", None]),
            "total_amount": rng.choice([5.0, 7.0, 0.0]),
            "kafka_offset": rng.randrange(1000),
            "kafka_partition": rng.randrange(3),
        }
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_a_recompute(spark, tmp_path, seed):
    base, rng = str(tmp_path), random.Random(seed)
    for day in range(3):
        arrive(spark, base, day, *copies(rng, day, 40))
        counts = process_silver(spark, base, "orders")
        assert counts["bronze_rows"] == counts["valid_rows"] + counts["quarantine_rows"]
        assert_equals_recompute(spark, base)
        if day == 1:
            # The same date grows after a run has read it.
            arrive(spark, base, day, *copies(rng, day, 10))
            process_silver(spark, base, "orders")
            assert_equals_recompute(spark, base)


def test_older_copies_that_arrive_later_lose(spark, tmp_path):
    base = str(tmp_path)
    arrive(spark, base, 0, {"event_id": "A", "kafka_offset": 9, "total_amount": 9.0})
    process_silver(spark, base, "orders")
    arrive(spark, base, 1, {"event_id": "A", "kafka_offset": 3, "total_amount": 3.0})
    counts = process_silver(spark, base, "orders")
    assert (counts["silver_rows"], counts["duplicate_rows"]) == (0, 2)
    assert_equals_recompute(spark, base)


def test_partition_that_loses_its_last_row_goes(spark, tmp_path):
    base = str(tmp_path)
    arrive(spark, base, 0, {"event_id": "A", "status": "pending"}, {"event_id": "B"})
    process_silver(spark, base, "orders")
    arrive(spark, base, 1, {"event_id": "A", "kafka_offset": 5})
    process_silver(spark, base, "orders")
    statuses = [r.status for r in read_layer(spark, base, "silver", "orders").collect()]
    assert statuses == ["completed", "completed"]
    assert_equals_recompute(spark, base)


def test_second_run_reads_new_dates_and_touched_partitions_only(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    for day in range(3):
        arrive(spark, base, day, {"event_id": f"E{day}", "timestamp": f"2026-01-0{day + 1}T01:00:00Z"})
    process_silver(spark, base, "orders")
    folders = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "silver/orders").glob("*/*=*")}
    read = []
    monkeypatch.setitem(
        S.CLEANERS, "orders", lambda rows, **o: (read.append(rows), CLEANERS_BEFORE(rows, **o))[1]
    )
    arrive(spark, base, 3, {"event_id": "E2", "kafka_offset": 8, "timestamp": "2026-01-03T02:00:00Z"})
    counts = process_silver(spark, base, "orders")
    # The last date read may have grown, so it is read again; earlier ones are not.
    assert counts["bronze_rows"] == 2
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(arrival_date" in plan and "2026-01-03" in plan
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "silver/orders").glob("*/*=*")}
    assert {n for n in after if after[n] != folders.get(n)} == {"event_date=2026-01-03"}
    assert_equals_recompute(spark, base)


CLEANERS_BEFORE = CLEANERS["orders"]


def test_rebuild_in_pieces_and_after_a_broken_run(spark, tmp_path, monkeypatch):
    base, rng = str(tmp_path), random.Random(5)
    arrive(spark, base, 0, *copies(rng, 0, 60))
    process_silver(spark, base, "orders", rebuild=True, pieces=3)
    assert_equals_recompute(spark, base)
    arrive(spark, base, 1, *copies(rng, 1, 60))

    def broken(*args, **options):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(S, "write_silver", broken)
        with pytest.raises(OSError):
            process_silver(spark, base, "orders")
    assert S.last_run(spark, base, "orders").phase == "begun"
    counts = process_silver(spark, base, "orders")
    assert counts["bronze_rows"] == 120
    assert_equals_recompute(spark, base)


def test_order_by_arrival(spark, tmp_path):
    base, late = str(tmp_path), datetime(2026, 1, 5)
    arrive(spark, base, 0, {"event_id": "A", "kafka_offset": 900, "kafka_partition": 0})
    arrive(spark, base, 0, {"event_id": "A", "kafka_offset": 5, "kafka_partition": 5, "kafka_timestamp": late})
    process_silver(spark, base, "orders", order=ARRIVAL_ORDER)
    assert read_layer(spark, base, "silver", "orders").first().kafka_partition == 5
    assert_equals_recompute(spark, base, order=ARRIVAL_ORDER)


def test_command_line_runs_all_jobs(spark, tmp_path, monkeypatch, caplog):
    from test_streaming import EVENT_TYPES, event, publish

    topics, base = str(tmp_path / "topics"), str(tmp_path / "tables")
    for name in EVENT_TYPES:
        for part in range(3):
            values = [event(name, event_id=f"E{part}{n}") for n in range(5)]
            publish(spark, topics, name, values, first=10 * part)
    common = ["--base", base]
    job.main(
        ["bronze", *common, "--checkpoints", str(tmp_path / "ck"), "--source-format", "parquet",
         "--source-base", topics, "--trigger", "available-now", "--source-option", "maxFilesPerTrigger=1"]
    )
    batches = list((tmp_path / "ck/bronze/orders/commits").glob("[0-9]*"))
    assert len(batches) == 3
    with caplog.at_level(logging.INFO):
        job.main(["silver", *common, "--detail", "--order", "arrival"])
    assert "'bronze_rows': 15" in caplog.text
    job.main(["gold", *common, "--keep", "1"])
    assert read_layer(spark, base, "gold", "summary").first().total_orders == 15
    for wrong in (["bronze", *common], ["bronze", *common, "--broker", "b", "--source-option", "x"]):
        with pytest.raises(SystemExit):
            job.main(wrong)
    assert "tillstream" in sys.modules
