from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import serving
from tillstream.operators.documents import with_doc_id
from tillstream.schemas import KPI_SCHEMAS

NOW = datetime(2026, 1, 2, 3, 0)
REGIONS = ("Asia", "Europe", "", None)


def frame(spark, kpi_type, rows):
    schema = KPI_SCHEMAS[kpi_type]
    filled = [tuple({"kpi_type": kpi_type, "computed_at": NOW, **r}.get(n) for n in schema.names) for r in rows]
    return spark.createDataFrame(filled, schema)


@pytest.fixture(scope="module")
def kpis(spark):
    hourly = [
        {"hour_bucket": NOW - timedelta(hours=h), "region": region, "revenue": 10.0 * h}
        for h in range(300)
        for region in REGIONS
    ]
    hourly.append({"hour_bucket": NOW - timedelta(hours=999), "region": "Zanzibar"})
    products = [
        {"product_id": f"SKU-{n}", "category": "Toys" if n % 2 else "Home", "revenue": float(n // 2)}
        for n in range(60)
    ]
    stock = [
        {"product_id": f"SKU-{n}", "warehouse_id": "WH-1", "current_stock": None if n == 3 else n * 37 % 100,
         "low_stock_alert": n % 2 == 1}
        for n in range(80)
    ]
    summaries = [
        {"id": f"summary_2026010{d}", "total_orders": d, "computed_at": NOW + timedelta(days=d)}
        for d in (2, 3, 1)
    ]
    tables = {
        "hourly_revenue": frame(spark, "hourly_revenue", hourly).drop("id"),
        "products": frame(spark, "products", products).drop("id"),
        "inventory": frame(spark, "inventory", stock).drop("id"),
        "conversion": frame(spark, "conversion", [{"total_clicks": 5}]).drop("id"),
        "summary": frame(spark, "summary", summaries),
    }
    return {name: with_doc_id(df, name).cache() for name, df in tables.items()}


def test_summary_is_the_newest(kpis):
    assert [r.total_orders for r in serving.get_summary(kpis).collect()] == [3]


def test_revenue_region_filter_and_order(kpis):
    rows = serving.get_revenue(kpis, region="Europe", limit=24).collect()
    assert {r.region for r in rows} == {"Europe"}
    assert [r.hour_bucket for r in rows] == [NOW - timedelta(hours=h) for h in range(24)]


def test_revenue_limits(kpis):
    assert serving.get_revenue(kpis).count() == 48
    assert serving.get_revenue(kpis, region="", limit=5).count() == 5
    assert serving.get_revenue(kpis, limit=200).count() == 200
    for limit in (0, -1, 201):
        with pytest.raises(ValueError):
            serving.get_revenue(kpis, limit=limit)


def test_region_text_is_a_value_not_code(kpis):
    assert serving.get_revenue(kpis, region="x' OR '1'='1").count() == 0


def test_products(kpis):
    rows = serving.get_products(kpis).collect()
    revenues = [r.revenue for r in rows]
    assert revenues == sorted(revenues, reverse=True) and len(rows) == 10
    assert revenues[0] == 29.0
    toys = serving.get_products(kpis, category="Toys", limit=50).collect()
    assert len(toys) == 30 and {r.category for r in toys} == {"Toys"}
    assert [r["rank"] for r in toys] == list(range(1, 31))
    for limit in (0, 51):
        with pytest.raises(ValueError):
            serving.get_products(kpis, limit=limit)


def test_inventory(kpis):
    rows = serving.get_inventory(kpis).collect()
    assert len(rows) == 40 and all(r.low_stock_alert for r in rows)
    stocks = [999 if r.current_stock is None else r.current_stock for r in rows]
    assert stocks == sorted(stocks) and rows[-1].current_stock is None
    assert serving.get_inventory(kpis, alerts_only=False, limit=200).count() == 80
    for limit in (0, 201):
        with pytest.raises(ValueError):
            serving.get_inventory(kpis, limit=limit)


def test_regions_come_from_all_rows(kpis):
    assert [r.region for r in serving.get_regions(kpis).collect()] == ["Asia", "Europe", "Zanzibar"]


def test_query_and_item(kpis):
    rows = serving.query_kpis(kpis, "inventory", {"low_stock_alert": False}).collect()
    assert len(rows) == 40 and [r.id for r in rows] == sorted(r.id for r in rows)
    assert serving.query_kpis(kpis, "hourly_revenue").count() == 100
    for limit in (0, -1, 1001):
        with pytest.raises(ValueError):
            serving.query_kpis(kpis, "inventory", limit=limit)
    hour = serving.get_item(kpis, "hourly_revenue_2026-01-02T03:00:00_Europe", "hourly_revenue")
    assert [r.revenue for r in hour.collect()] == [0.0]
    assert serving.get_item(kpis, "nothing", "summary").count() == 0


def test_missing_kpi_is_empty(spark):
    empty = {name: spark.createDataFrame([], schema) for name, schema in KPI_SCHEMAS.items()}
    for read in (serving.get_summary, serving.get_conversion, serving.get_revenue):
        assert read(empty).count() == 0


def test_envelope_keeps_the_page_order(kpis):
    page = serving.get_revenue(kpis, region="Asia", limit=100)
    row = serving.envelope(page, region_filter="Asia").first()
    assert (row.status, row["count"], row.region_filter) == ("ok", 100, "Asia")
    assert [r.hour_bucket for r in row.data] == [NOW - timedelta(hours=h) for h in range(100)]
    empty = serving.envelope(page.filter(F.lit(False)), region_filter=None).first()
    assert (empty["count"], empty.data, empty.region_filter) == (0, [], None)


def test_reads_keep_only_the_wanted_rows(kpis):
    plan = serving.get_revenue(kpis)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_envelope_refuses_more_than_a_page(spark):
    page = spark.range(1001)
    with pytest.raises(Exception, match="1000 rows at most"):
        serving.envelope(page).collect()
    assert serving.envelope(page.limit(1000)).first()["count"] == 1000
