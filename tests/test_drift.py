"""Fields beyond the contract, and reads of one stored row."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_lookup import rows_read

import __spark_entry__ as registry
from testbed.events import drifted_records
from tillstream.operators import drift, ingest, serving
from tillstream.plans.gold import load_kpis, save_kpi
from tillstream.schemas import ORDERS


def bronze(spark, *records):
    return spark.createDataFrame([(r,) for r in records], "_raw string")


def test_new_fields_are_reported_and_read_back(spark):
    rows = bronze(
        spark,
        '{"event_id": "A", "coupon": "X1", "quantity": 2}',
        '{"event_id": "B", "coupon": 7, "quantity": "two", "product": {"id": "P", "brand": {"name": "b"}}}',
        '{"event_id": "C", "coupon": null, "quantity": "3", "product": 5}',
        '{"event_id": 9, "note": [1, 2]}',
        "not json",
        "[1]",
        None,
    )
    found = {(r.path, r.type, r.finding): r.rows for r in drift.drift_report(rows, ORDERS).collect()}
    assert found == {
        ("coupon", "STRING", "undeclared"): 1,
        ("coupon", "BIGINT", "undeclared"): 1,
        ("quantity", "STRING", "unreadable"): 1,
        ("product.brand", "OBJECT<name: STRING>", "undeclared"): 1,
        ("note", "ARRAY<BIGINT>", "undeclared"): 1,
    }
    coupons = drift.with_raw_field(rows, "coupon", "string").select("coupon").collect()
    assert [r.coupon for r in coupons] == ["X1", "7", None, None, None, None, None]
    brands = drift.with_raw_field(rows, "product.brand.name", "string", "brand")
    assert [r.brand for r in brands.collect()][1] == "b"
    assert "coupon" in drift.record_schema(rows.filter("_raw like '{%'")).first().schema
    assert drift.drift_report(rows.limit(0), ORDERS).count() == 0


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_report_makes_reads_and_parses_each_record_once(spark):
    rows = ingest.to_bronze(drifted_records(spark, "/root/testdata/sf0.001"), ORDERS)
    plan = optimized(drift.drift_report(rows, ORDERS))
    assert plan.count("StructsToJsonEvaluator") == plan.count("parseJson(") == 1
    assert plan.count("Relation [l_orderkey#") == 1


def test_values_are_judged_by_what_they_can_be_read_as(spark):
    values = ["1", "0.5", "3000000000", '"1.5"', '"x"', "true", "[1]", "{}", "null"]
    rows = bronze(spark, *[f'{{"quantity": {v}, "subtotal": {v}, "event_id": {v}}}' for v in values])
    found = {(r.path, r.type): r.rows for r in drift.drift_report(rows, ORDERS).collect()}
    assert found == {
        ("quantity", "BIGINT"): 1,
        ("quantity", "STRING"): 2,
        ("quantity", "ARRAY<BIGINT>"): 1,
        ("quantity", "OBJECT<>"): 1,
        ("subtotal", "STRING"): 1,
        ("subtotal", "ARRAY<BIGINT>"): 1,
        ("subtotal", "OBJECT<>"): 1,
    }
    nested = bronze(spark, '{"product.id": 1, "product": {"unit_price": "?", "id": 2, "quantity": 1}}')
    found = {(r.path, r.type, r.finding) for r in drift.drift_report(nested, ORDERS).collect()}
    assert found == {
        ("product.id", "BIGINT", "undeclared"),
        ("product.unit_price", "STRING", "unreadable"),
        ("product.quantity", "BIGINT", "undeclared"),
    }


def test_a_filter_of_raw_fields_parses_no_record_again(spark):
    rows = ingest.to_bronze(drifted_records(spark, "/root/testdata/sf0.001"), ORDERS)
    fields = {"coupon": ("coupon", "string"), "brand": ("product.brand", "string")}
    found = drift.with_raw_fields(rows, fields).filter("coupon is not null").groupBy("coupon", "brand").count()
    plan = optimized(found)
    assert plan.count("StructsToJsonEvaluator") == plan.count("parseJson(") == 1
    query = optimized(registry.queries()["drifted_coupons"](spark, "/root/testdata/sf0.001"))
    assert query.count("StructsToJsonEvaluator") == query.count("parseJson(") == 1


def test_one_stored_row_is_read_by_its_id(spark, tmp_path, monkeypatch):
    from tillstream.plans import gold

    monkeypatch.setattr(gold, "ID_GROUP_BYTES", 1 << 14)
    count = 40_000
    rows = spark.range(count).select(
        F.concat(F.lit("P"), "id").alias("product_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("product_name"),
        F.lit("W").alias("warehouse_id"),
        F.col("id").cast("int").alias("current_stock"),
        F.lit(5).alias("reorder_threshold"),
        F.lit(False).alias("low_stock_alert"),
        F.lit("inventory").alias("kpi_type"),
        F.lit(datetime(2026, 1, 1)).alias("computed_at"),
    )
    save_kpi(spark, str(tmp_path), "inventory", rows)
    kpis = load_kpis(spark, str(tmp_path), kpi_types=["inventory"])
    wanted = kpis["inventory"].filter("current_stock = 31234").first()
    item = serving.get_item(kpis, wanted.id, "inventory")
    plan = item._jdf.queryExecution().toString()
    assert f"PushedFilters: [IsNotNull(id), EqualTo(id,{wanted.id[:20]}" in plan.replace("\n", "")
    assert item.first().current_stock == 31234
    # Of all row groups only the one whose ids can hold it is read, and of that some pages.
    assert rows_read(item) <= count / 20
    missing = serving.get_item(kpis, wanted.id + "x", "inventory")
    assert missing.count() == 0 and rows_read(missing) <= count / 20
    with pytest.raises(ValueError, match="limit"):
        serving.query_kpis(kpis, "inventory", limit=0)
