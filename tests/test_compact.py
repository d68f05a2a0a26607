"""Copies of closed bronze dates, and rebuilds that read them."""

import random
from datetime import date, timedelta

import pytest
from factories import bronze
from pyspark.sql import functions as F
from test_incremental import FIRST, arrive, assert_equals_recompute, contents, copies

from tillstream import __main__ as job
from tillstream.plans import compact as C
from tillstream.plans.silver import last_run, process_silver
from tillstream.schemas import EVENT_TYPES
from tillstream.sources.tables import layer_path, read_layer, read_table


@pytest.fixture
def base(spark, tmp_path):
    """Three past dates in many small files, and one that is not over."""
    base, rng = str(tmp_path), random.Random(3)
    for day in range(3):
        for _ in range(4):
            arrive(spark, base, day, *copies(rng, day, 10))
    arrive(spark, base, (date.today() - FIRST).days, *copies(rng, 3, 10))
    return base


def files(df):
    return sorted(df.inputFiles())


def test_copies_hold_the_same_rows_in_few_files(spark, base):
    copied = C.compact_bronze(spark, base, "orders")
    assert copied == {FIRST + timedelta(days=day): 40 for day in range(3)}
    schema = EVENT_TYPES["orders"].bronze_table_schema
    copies = read_table(spark, C.compact_path(base, "orders"), schema=schema)
    stored = read_layer(spark, base, "bronze", "orders")
    assert len(files(copies)) == 3 < len(files(stored)) == 13
    whole = C.all_bronze(spark, base, "orders")
    assert contents(whole) == contents(stored)
    by_date = stored.groupBy("arrival_date").count()
    assert sorted(by_date.collect()) == sorted(whole.groupBy("arrival_date").count().collect())
    # What packs the files is not left behind in the session.
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1"


def test_only_new_closed_dates_are_copied(spark, base):
    assert len(C.compact_bronze(spark, base, "orders")) == 3
    assert C.compact_bronze(spark, base, "orders") == {}
    arrive(spark, base, 5, {})
    assert C.compact_bronze(spark, base, "orders") == {FIRST + timedelta(days=5): 1}
    # Today's date is never over.
    assert C.compact_bronze(spark, base, "orders", settled_days=0) == {}
    with pytest.raises(ValueError, match="not over"):
        C.compact_bronze(spark, base, "orders", settled_days=-1)


def test_rebuilds_read_the_copies(spark, base):
    C.compact_bronze(spark, base, "orders")
    rows = C.all_bronze(spark, base, "orders")
    plan = rows.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    paths = [r[0] for r in rows.select(F.input_file_name()).distinct().collect()]
    assert sum("/bronze_compact/" in p for p in paths) == 3 and len(paths) == 4
    counts = process_silver(spark, base, "orders", rebuild=True)
    assert counts["bronze_rows"] == 130
    assert_equals_recompute(spark, base)


def test_a_copy_that_broke_off_is_not_read_and_written_again(spark, base, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(C, "read_table", lambda *a, **k: bronze(spark, "orders", {}))
        with pytest.raises(RuntimeError, match="40 rows read, 1 in the copy"):
            C.compact_bronze(spark, base, "orders")
    assert C.compacted_dates(spark, base, "orders") == []
    assert C.all_bronze(spark, base, "orders").count() == 130
    assert len(C.compact_bronze(spark, base, "orders")) == 3
    assert C.all_bronze(spark, base, "orders").count() == 130


def test_rows_without_a_date_and_large_files(spark, base):
    path = layer_path(base, "bronze", "orders")
    undated = bronze(spark, "orders", {}).withColumn("arrival_date", F.lit(None).cast("date"))
    undated.write.mode("append").partitionBy("arrival_date").parquet(path)
    # Files larger than asked for are cut, never joined.
    C.compact_bronze(spark, base, "orders", file_bytes=1 << 12)
    whole = C.all_bronze(spark, base, "orders")
    assert whole.filter("arrival_date is null").count() == 1
    assert contents(whole) == contents(read_layer(spark, base, "bronze", "orders"))


def test_counts_and_last_date_come_from_the_cleaning_pass(spark, base):
    first = process_silver(spark, base, "orders")
    assert first["bronze_rows"] == first["valid_rows"] + first["quarantine_rows"] == 130
    assert last_run(spark, base, "orders").upto == str(date.today())
    # The next run reads the last date alone.
    assert process_silver(spark, base, "orders")["bronze_rows"] == 10
    assert last_run(spark, base, "orders").upto == str(date.today())


def test_command_line(spark, base):
    for name in ("clicks", "inventory"):
        rows = bronze(spark, name, {}).withColumn("arrival_date", F.lit(FIRST))
        rows.write.partitionBy("arrival_date").parquet(layer_path(base, "bronze", name))
    job.main(["compact", "--base", base, "--file-mb", "64"])
    for name, dates in {"orders": 3, "clicks": 1, "inventory": 1}.items():
        assert len(C.compacted_dates(spark, base, name)) == dates
    with pytest.raises(SystemExit):
        job.main(["compact", "--base", base, "--format", "delta"])
