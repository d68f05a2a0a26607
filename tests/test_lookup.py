"""Filters of ids, and joins that prune partitions while they run."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_incremental import FIRST, arrive, assert_equals_recompute

from tillstream.operators import lookup
from tillstream.plans import silver as S
from tillstream.plans.silver import process_silver
from tillstream.sources.tables import layer_path, read_layer


def rows_read(df):
    """How many rows the scan of a frame's first table hands on, before any join."""
    df.collect()
    for leaf in leaves(df._jdf.queryExecution().executedPlan()):
        if leaf.nodeName().startswith("Scan"):
            return leaf.metrics().get("numOutputRows").get().value()
    raise AssertionError("no scan")


def leaves(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.finalPhysicalPlan()
    found = plan.collectLeaves()
    return [found.apply(k) for k in range(found.size())]


@pytest.mark.parametrize("words", [lookup.LEAST_WORDS, 1])
def test_id_filter_loses_nothing(spark, monkeypatch, words):
    monkeypatch.setattr(lookup, "filter_words", lambda ids: words)
    table = spark.range(40_000).selectExpr("concat('E', id) as event_id")
    ids = spark.range(0, 40_000, 50).selectExpr("concat('E', id) as event_id")
    passed = lookup.likely_in(table, ids, "event_id", 800)
    assert passed.join(ids, "event_id", "left_semi").count() == 800
    assert passed.count() < 1200 or words == 1


def test_id_filter_of_no_ids_and_of_null(spark):
    table = spark.range(10).selectExpr("if(id = 3, null, string(id)) as event_id")
    assert lookup.likely_in(table, table.limit(0), "event_id", 0).count() == 0
    assert lookup.likely_in(table, table.filter("event_id is null"), "event_id", 1).count() >= 1


def test_filter_size_follows_the_ids_up_to_a_bound():
    sizes = [lookup.filter_words(n) for n in (0, 10_000, 1_000_000, 10**9)]
    assert sizes == sorted(sizes) and sizes[0] == lookup.LEAST_WORDS and sizes[-1] == lookup.MOST_WORDS


def test_only_listed_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(60).selectExpr(
        "id", "if(id % 3 = 0, null, concat('a b/', id % 3)) as status", "date_add('2026-01-01', int(id % 20)) as day"
    )
    days.repartition("status", "day").write.partitionBy("status", "day").parquet(path)
    table = spark.read.schema(days.schema).parquet(path)
    wanted = days.filter("id in (0, 21, 40)").select("status", "day")
    wanted.coalesce(1).write.parquet(str(tmp_path / "wanted"))
    found = lookup.in_partitions(table, spark.read.parquet(str(tmp_path / "wanted")), ["status", "day"])
    assert "dynamicpruning" in found._jdf.queryExecution().toString()
    assert sorted(r.id for r in found.collect()) == [0, 21, 40]
    # Every partition is a file with one row, so as many files are read.
    assert len(list((tmp_path / "t").glob("*/*/*.parquet"))) == 60
    assert rows_read(found) == 3


def test_hundreds_of_partitions_change_in_one_run(spark, tmp_path):
    base, count = str(tmp_path), 450
    path = layer_path(base, "bronze", "orders")

    def send(day, offset, amount):
        """The same orders, one per event date, all in one arrival date."""
        template = S.read_layer(spark, base, "bronze", "orders").limit(1)
        many = spark.range(count).crossJoin(template).withColumns(
            {
                "event_id": F.concat(F.lit("E"), "id"),
                "timestamp": F.concat(F.expr("date_add('2020-01-01', int(id))"), F.lit("T05:00:00Z")),
                "kafka_offset": F.lit(offset).cast("bigint"),
                "total_amount": F.lit(amount),
                "arrival_date": F.lit(FIRST + timedelta(days=day)),
            }
        )
        many.drop("id").coalesce(1).write.mode("append").partitionBy("arrival_date").parquet(path)

    arrive(spark, base, 0, {"event_id": "X", "timestamp": "2019-12-31T00:00:00Z"})
    send(1, 5, 10.0)
    process_silver(spark, base, "orders")
    send(2, 6, 20.0)
    counts = process_silver(spark, base, "orders")
    assert counts["silver_rows"] == count
    silver = read_layer(spark, base, "silver", "orders")
    assert silver.filter("total_amount = 20.0").count() == count and silver.count() == count + 1


def test_partition_folders_with_odd_names(spark, tmp_path):
    base = str(tmp_path)
    odd = "a/b:c=d%e f"
    arrive(spark, base, 0, {"event_id": "A", "status": odd}, {"event_id": "B", "timestamp": None})
    process_silver(spark, base, "orders")
    arrive(
        spark, base, 1, {"event_id": "A", "kafka_offset": 5}, {"event_id": "B", "kafka_offset": 5}
    )
    process_silver(spark, base, "orders")
    assert_equals_recompute(spark, base)
    assert S._folder(read_layer(spark, base, "silver", "orders").first(), ["event_date"]).startswith("event_date=2026")
    assert date(2026, 1, 1) == FIRST
