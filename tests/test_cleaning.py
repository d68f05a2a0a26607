import random
from datetime import datetime

import pytest
from factories import ARRIVED, bronze, values
from pyspark.sql import functions as F

from tillstream.operators import amounts
from tillstream.operators.cleaning import (
    CLEANERS,
    clean_clicks,
    clean_inventory,
    clean_orders,
    enrich_orders,
)
from tillstream.operators.dedup import dedup_latest
from tillstream.operators.validation import quarantined_rows, split_valid, valid_rows
from tillstream.schemas import CLICKS, EVENT_TYPES, INVENTORY, ORDERS

NAN = float("nan")


@pytest.mark.parametrize(
    "change",
    [
        {"event_id": None},
        {"order_id": None},
        {"customer_id": None},
        {"status": None},
        {"total_amount": 0.0},
        {"total_amount": -10.0},
        {"total_amount": None},
    ],
)
def test_invalid_order_is_quarantined(spark, change):
    silver, rejected = clean_orders(bronze(spark, "orders", change, {}))
    assert silver.count() == 1
    reasons = values(rejected, "quarantine_reason")
    assert reasons == ["missing_required_fields_or_invalid_amount"]


@pytest.mark.parametrize("column", ["event_id", "session_id", "product_id"])
def test_invalid_click_is_quarantined(spark, column):
    silver, rejected = clean_clicks(bronze(spark, "clicks", {column: None}, {}))
    assert silver.count() == 1
    assert values(rejected, "quarantine_reason") == ["missing_required_click_fields"]


@pytest.mark.parametrize(
    "change", [{"event_id": None}, {"product_id": None}, {"stock_level": -1}, {"stock_level": None}]
)
def test_invalid_inventory_is_quarantined(spark, change):
    silver, rejected = clean_inventory(bronze(spark, "inventory", change, {"stock_level": 0}))
    assert values(silver, "stock_level") == [0]
    assert values(rejected, "quarantine_reason") == ["invalid_inventory_event"]


@pytest.mark.parametrize("strict", [False, True])
def test_empty_and_all_valid_input(spark, strict):
    for name, clean in CLEANERS.items():
        silver, rejected = clean(bronze(spark, name, {}).limit(0), strict=strict)
        assert (silver.count(), rejected.count()) == (0, 0)
        silver, rejected = clean(bronze(spark, name, {}, {}), strict=strict)
        assert (silver.count(), rejected.count()) == (2, 0)


@pytest.mark.parametrize("strict", [False, True])
def test_valid_and_quarantined_are_complements(spark, strict):
    """Every mix of missing, blank, NaN and out-of-range values is in exactly one output."""
    random.seed(7)
    texts, numbers = [None, "", "  ", "x"], [None, NAN, float("inf"), -1.0, 0.0, 0.01]
    changes = [
        {
            "event_id": random.choice(texts),
            "order_id": random.choice(texts),
            "customer_id": random.choice(texts),
            "status": random.choice(texts),
            "total_amount": random.choice(numbers),
            "kafka_offset": n,
        }
        for n in range(400)
    ]
    rows = bronze(spark, "orders", *changes)
    valid, rejected = split_valid(rows, ORDERS, strict)
    kept, dropped = values(valid, "kafka_offset"), values(rejected, "kafka_offset")
    assert sorted(kept + dropped) == list(range(400))

    def expected(c):
        texts_ok = all(
            c[k] is not None and (c[k].strip() or not strict)
            for k in ("event_id", "order_id", "customer_id", "status")
        )
        amount = c["total_amount"]
        is_nan = amount is not None and amount != amount
        amount_ok = amount is not None and (amount > 0 or (is_nan and not strict))
        return texts_ok and amount_ok

    assert kept == [c["kafka_offset"] for c in changes if expected(c)]


def test_detail_names_the_broken_rules(spark):
    rows = bronze(spark, "orders", {"event_id": None, "total_amount": None}, {"status": None})
    rejected = quarantined_rows(rows, ORDERS, detail=True)
    assert values(rejected, "failed_rules") == [
        ["missing_event_id", "invalid_total_amount"],
        ["missing_status"],
    ]


def test_text_is_standardised(spark):
    messy = {
        "status": "  COMPLETED  ",
        "customer_id": " cust-1234 ",
        "region": " Europe ",
        "payment_method": " PayPal",
        "currency": "usd ",
    }
    row = clean_orders(bronze(spark, "orders", messy))[0].first()
    assert (row.status, row.customer_id, row.region) == ("completed", "CUST-1234", "Europe")
    assert (row.payment_method, row.currency) == ("paypal", "USD")
    messy = {"customer_id": " c-1", "page": " HomePage ", "category": " Home", "region": "EU "}
    row = clean_clicks(bronze(spark, "clicks", messy))[0].first()
    assert (row.customer_id, row.page, row.category, row.region) == ("C-1", "homepage", "Home", "EU")
    messy = {"product_id": " sku-1", "warehouse_id": "wh-01 ", "action": " Restock"}
    row = clean_inventory(bronze(spark, "inventory", messy))[0].first()
    assert (row.product_id, row.warehouse_id, row.action) == ("SKU-1", "WH-01", "restock")


def test_order_flags(spark):
    rows = bronze(
        spark,
        "orders",
        {"total_amount": 250.0, "discount_pct": 0.10},
        {"total_amount": 200.0, "discount_pct": 0.0},
        {"total_amount": 99.0, "discount_pct": None},
    )
    flags = enrich_orders(rows).orderBy("event_id").select("is_high_value", "is_discounted")
    assert [tuple(r) for r in flags.collect()] == [(True, True), (True, False), (False, None)]


def test_page_time_is_a_magnitude(spark):
    rows = bronze(
        spark,
        "clicks",
        {"time_on_page_sec": -30},
        {"time_on_page_sec": 30},
        {"time_on_page_sec": None},
        {"time_on_page_sec": -(2**31)},
    )
    silver = clean_clicks(rows)[0].orderBy("event_id")
    assert [r.time_on_page_sec for r in silver.collect()] == [30, 30, None, None]


def test_unreadable_timestamp_keeps_the_row(spark):
    rows = bronze(spark, "orders", {"timestamp": "soon"}, {"timestamp": None}, {})
    silver = clean_orders(rows)[0].orderBy("event_id")
    moment = datetime(2026, 1, 2, 3, 4, 5, 123456)
    stamps = silver.select(F.col("event_ts").cast("timestamp_ntz")).collect()
    assert [r[0] for r in stamps] == [None, None, moment]


def test_latest_offset_wins(spark):
    rows = bronze(
        spark,
        "orders",
        {"event_id": "DUP", "kafka_offset": 1},
        {"event_id": "DUP", "kafka_offset": 5, "region": "Asia"},
        {"event_id": "ONE", "kafka_offset": 2},
    )
    silver = clean_orders(rows)[0]
    assert values(silver, "kafka_offset") == [2, 5]


def test_invalid_copy_does_not_replace_a_valid_one(spark):
    rows = bronze(
        spark,
        "orders",
        {"event_id": "DUP", "kafka_offset": 1},
        {"event_id": "DUP", "kafka_offset": 9, "total_amount": 0.0},
    )
    silver, rejected = clean_orders(rows)
    assert (values(silver, "kafka_offset"), values(rejected, "kafka_offset")) == ([1], [9])


def test_equal_offsets_are_settled_by_partition_and_time(spark):
    later = datetime(2026, 1, 2, 3, 6)
    rows = bronze(
        spark,
        "clicks",
        {"event_id": "A", "kafka_partition": 0, "region": "p0"},
        {"event_id": "A", "kafka_partition": 1, "region": "p1"},
        {"event_id": "B", "kafka_timestamp": ARRIVED, "region": "early"},
        {"event_id": "B", "kafka_timestamp": later, "region": "late"},
    )
    assert values(clean_clicks(rows)[0], "region") == ["late", "p1"]


def test_dedup_equals_brute_force_with_a_hot_key(spark):
    """A third of all rows are copies of one event, spread over all partitions."""
    n = 30_000
    rows = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .otherwise(F.concat(F.lit("K"), F.col("id") % 5000))
        .alias("event_id"),
        F.pmod(F.hash("id"), F.lit(1000)).cast("long").alias("kafka_offset"),
        F.col("id").cast("int").alias("kafka_partition"),
    )
    best: dict[str, tuple] = {}
    for row in rows.collect():
        best[row.event_id] = max(best.get(row.event_id, (-1, -1)), tuple(row)[1:])
    found = {r.event_id: tuple(r)[1:] for r in dedup_latest(rows).collect()}
    assert found == best


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = dedup_latest(bronze(spark, "orders", {}))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


def test_derived_amounts(spark):
    rows = bronze(
        spark,
        "orders",
        {"product": ("a", "b", "c", 49.99), "quantity": 2, "discount_pct": 0.1},
        {"product": ("a", "b", "c", 0.25), "quantity": 1, "discount_pct": 0.5},
    )
    priced = amounts.derive_order_amounts(rows).orderBy("event_id")
    found = priced.select("subtotal", "discount_amount", "total_amount").collect()
    assert [tuple(r) for r in found] == [(99.98, 10.0, 89.98), (0.25, 0.13, 0.12)]


def test_amount_check_flags_each_amount(spark):
    good = {"product": ("a", "b", "c", 25.0), "quantity": 2, "subtotal": 50.0}
    rows = bronze(
        spark,
        "orders",
        good,
        {**good, "subtotal": 50.01, "total_amount": 50.01},
        {**good, "discount_amount": 1.0, "total_amount": 49.0},
        {**good, "total_amount": None},
    )
    wrong = amounts.check_amounts(rows).orderBy("event_id")
    flags = wrong.select("event_id", "subtotal_ok", "discount_ok", "total_ok").collect()
    assert [tuple(r) for r in flags] == [
        ("EVT-001", False, True, True),
        ("EVT-002", True, False, True),
        ("EVT-003", True, True, False),
    ]


def test_low_stock(spark):
    rows = bronze(
        spark,
        "inventory",
        {"stock_level": 49, "low_stock_alert": False},
        {"stock_level": 50, "low_stock_alert": False},
    )
    assert values(amounts.check_low_stock(rows), "event_id") == ["EVT-000"]
    derived = amounts.derive_low_stock(rows).orderBy("event_id")
    assert [r.low_stock_alert for r in derived.collect()] == [True, False]


def test_checks_reach_the_file_scan(spark, tmp_path):
    for name, spec in EVENT_TYPES.items():
        path = str(tmp_path / name)
        bronze(spark, name, {}).write.parquet(path)
        stored = spark.read.schema(spec.bronze_schema).parquet(path)
        for half in (valid_rows(stored, spec), quarantined_rows(stored, spec)):
            plan = half._jdf.queryExecution().executedPlan().toString()
            pushed = plan[plan.index("PushedFilters: ") :].split("]")[0]
            for column in spec.required:
                assert column in pushed


def test_specs_differ_only_where_stated():
    assert ORDERS.silver_partition == "status"
    assert CLICKS.silver_partition == INVENTORY.silver_partition == "source_topic"
    assert CLICKS.bound is None and INVENTORY.bound.inclusive and not ORDERS.bound.inclusive
