import json
from datetime import datetime, timezone

import pytest
from factories import bronze, values
from pyspark.sql import functions as F

from tillstream.operators import kpis as K
from tillstream.operators import serving
from tillstream.plans.gold import expire_kpis, load_kpis, run_gold, save_kpi
from tillstream.plans.silver import process_silver, run_silver
from tillstream.schemas import KPI_SCHEMAS
from tillstream.sources.tables import layer_path, read_layer, read_quarantine

DAYS = [datetime(2026, 1, d, tzinfo=timezone.utc) for d in (2, 3)]


def store(spark, base, name, *changes):
    bronze(spark, name, *changes).write.mode("overwrite").parquet(layer_path(base, "bronze", name))


@pytest.fixture
def base(spark, tmp_path):
    base = str(tmp_path)
    store(
        spark,
        base,
        "orders",
        {"total_amount": 100.0, "timestamp": "soon"},
        {"total_amount": 20.0},
        {"total_amount": 5.0, "status": " Failed"},
        {"event_id": "EVT-001", "total_amount": 30.0, "kafka_offset": 8},
        {"order_id": None},
        {"total_amount": float("nan")},
    )
    store(spark, base, "clicks", {}, {"added_to_cart": False}, {"session_id": None})
    store(spark, base, "inventory", {}, {"warehouse_id": "wh-02", "stock_level": 3})
    return base


def test_counts_are_taken_while_writing(spark, base):
    counts = run_silver(spark, base)
    assert counts["orders"] == {
        "bronze_rows": 6,
        "valid_rows": 5,
        "quarantine_rows": 1,
        "silver_rows": 4,
        "duplicate_rows": 1,
        "unreadable_timestamps": 1,
        "unreadable_amounts": 1,
    }
    assert counts["clicks"]["silver_rows"] == 2 and counts["clicks"]["quarantine_rows"] == 1
    assert counts["inventory"]["quarantine_rows"] == 0


def test_silver_reruns_replace(spark, base):
    for _ in range(2):
        run_silver(spark, base)
        assert read_layer(spark, base, "silver", "orders").count() == 4
        assert read_quarantine(spark, base, "orders").count() == 1
    # Bronze itself was replaced, which only a rebuild can see.
    store(spark, base, "orders", {})
    process_silver(spark, base, "orders", rebuild=True)
    assert values(read_layer(spark, base, "silver", "orders"), "status") == ["completed"]
    assert read_quarantine(spark, base, "orders").count() == 0


def test_strict_and_detail_reach_the_job(spark, base):
    counts = process_silver(spark, base, "orders", strict=True, detail=True)
    assert (counts["silver_rows"], counts["quarantine_rows"]) == (3, 2)
    rejected = read_quarantine(spark, base, "orders")
    assert ["invalid_total_amount"] in values(rejected, "failed_rules")


def test_gold_reads_only_completed_orders_and_needed_columns(spark, base):
    run_silver(spark, base)
    orders = read_layer(spark, base, "silver", "orders")
    plan = K.hourly_revenue(orders)._jdf.queryExecution().executedPlan().toString()
    assert "(status#" in plan and "= completed)]" in plan.split("PartitionFilters")[1]
    schema = plan.split("ReadSchema: ")[1]
    assert "customer_id" in schema and "product" not in schema and "currency" not in schema


def test_gold_tables_and_stored_kpis(spark, base, tmp_path):
    run_silver(spark, base)
    for day in (*DAYS, DAYS[1]):
        run_gold(spark, base, as_of=day, export=str(tmp_path / "export"))
    for kpi_type, rows in {
        "hourly_revenue": 2,
        "products": 1,
        "top_products": 1,
        "conversion": 1,
        "inventory": 2,
        "summary": 1,
    }.items():
        gold = read_layer(spark, base, "gold", kpi_type)
        assert gold.count() == rows
        assert set(gold.columns) | {"id"} == set(KPI_SCHEMAS[kpi_type].names)
        exported = spark.read.json(str(tmp_path / "export" / kpi_type))
        assert exported.count() == rows

    kpis = load_kpis(spark, base)
    for kpi_type, df in kpis.items():
        assert {f.name: f.dataType for f in df.schema} == {
            f.name: f.dataType for f in KPI_SCHEMAS[kpi_type]
        }
        assert df.select("id").distinct().count() == df.count()
    # One summary per day is kept; the read returns the newest.
    assert values(kpis["summary"], "id") == ["summary_20260102", "summary_20260103"]
    assert serving.get_summary(kpis).first().id == "summary_20260103"
    assert kpis["inventory"].count() == 2
    assert values(serving.get_inventory(kpis, alerts_only=False), "warehouse_id") == ["WH-01", "WH-02"]


def test_kpi_store_starts_empty_and_survives_a_failed_write(spark, base):
    assert all(df.count() == 0 for df in load_kpis(spark, base).values())
    run_silver(spark, base)
    kpi = K.inventory_status(read_layer(spark, base, "silver", "inventory"), DAYS[0])
    save_kpi(spark, base, "inventory", kpi)
    broken = kpi.withColumn("current_stock", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        save_kpi(spark, base, "inventory", broken)
    stored = load_kpis(spark, base)["inventory"]
    assert values(stored, "current_stock") == [3, 100]


def test_json_export_is_one_object_per_row(spark, base, tmp_path):
    run_silver(spark, base)
    run_gold(spark, base, as_of=DAYS[0], latest_stock=True, export=str(tmp_path / "out"))
    lines = [
        json.loads(line)
        for file in (tmp_path / "out" / "inventory").glob("part-*")
        for line in file.read_text().splitlines()
    ]
    assert {line["warehouse_id"]: line["current_stock"] for line in lines} == {"WH-01": 100, "WH-02": 3}


def test_snapshots_forget_and_categories_see_all_products(spark, base):
    def sold(day, *sales):
        rows = [
            {"product": (f"SKU-{n:02}", f"P{n}", "Toys" if n == 11 else "Home", 1.0), "total_amount": a}
            for n, a in sales
        ]
        store(spark, base, "orders", *rows)
        run_silver(spark, base, rebuild=True)
        run_gold(spark, base, as_of=day)
        return load_kpis(spark, base)

    kpis = sold(DAYS[0], *[(n, 100.0 - n) for n in range(12)])
    toys = serving.get_products(kpis, category="Toys").collect()
    assert [(r.product_id, r["rank"]) for r in toys] == [("SKU-11", 1)]
    assert kpis["products"].count() == 12 and kpis["top_products"].count() == 10
    assert serving.get_products(kpis, limit=50).count() == 12

    kpis = sold(DAYS[1], *[(n, 10.0 + n) for n in range(20, 35)])
    assert sorted(r["rank"] for r in kpis["top_products"].collect()) == list(range(1, 11))
    leaders = serving.get_products(kpis, limit=50).collect()
    assert [r.product_id for r in leaders] == [f"SKU-{n}" for n in range(34, 19, -1)]


def test_old_versions_expire(spark, base):
    run_silver(spark, base, event_types=["inventory"])
    kpi = K.inventory_status(read_layer(spark, base, "silver", "inventory"), DAYS[0])
    for _ in range(4):
        save_kpi(spark, base, "inventory", kpi)
    before = load_kpis(spark, base)["inventory"].collect()
    assert expire_kpis(spark, base, keep=2) == 2
    assert expire_kpis(spark, base, keep=2) == 0
    assert load_kpis(spark, base)["inventory"].collect() == before
    with pytest.raises(ValueError):
        expire_kpis(spark, base, keep=0)
