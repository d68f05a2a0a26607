"""Bronze rows with defaults, for the tests to vary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tillstream.schemas import EVENT_TYPES

ARRIVED = datetime(2026, 1, 2, 3, 5)
WHEN = "2026-01-02T03:04:05.123456+00:00"

DEFAULTS = {
    "orders": {
        "event_type": "order",
        "event_id": "EVT-001",
        "timestamp": WHEN,
        "order_id": "ORD-001",
        "customer_id": "CUST-1",
        "region": "Europe",
        "product": ("SKU-1", "Lamp", "Home", 25.0),
        "quantity": 2,
        "subtotal": 50.0,
        "discount_pct": 0.0,
        "discount_amount": 0.0,
        "total_amount": 50.0,
        "currency": "USD",
        "payment_method": "paypal",
        "status": "completed",
    },
    "clicks": {
        "event_type": "click",
        "event_id": "EVT-001",
        "timestamp": WHEN,
        "session_id": "SESS-001",
        "customer_id": "CUST-1",
        "region": "Europe",
        "product_id": "SKU-001",
        "product_name": "Lamp",
        "category": "Home",
        "page": "homepage",
        "added_to_cart": True,
        "time_on_page_sec": 120,
    },
    "inventory": {
        "event_type": "inventory",
        "event_id": "EVT-001",
        "timestamp": WHEN,
        "product_id": "SKU-1",
        "product_name": "Lamp",
        "warehouse_id": "WH-01",
        "stock_level": 100,
        "reorder_threshold": 50,
        "low_stock_alert": False,
        "action": "restock",
    },
}


def bronze(spark: SparkSession, event_type: str, *changes: dict) -> DataFrame:
    """One bronze row per dict of changes."""
    schema = EVENT_TYPES[event_type].bronze_schema
    ingestion = {
        "kafka_offset": 1,
        "kafka_partition": 0,
        "kafka_timestamp": ARRIVED,
        "ingested_at": ARRIVED,
        "source_topic": event_type,
        "_raw": None,
    }
    rows = []
    for number, change in enumerate(changes):
        numbered = {"event_id": f"EVT-{number:03d}"}
        row = {**DEFAULTS[event_type], **ingestion, **numbered, **change}
        rows.append(tuple(row[name] for name in schema.names))
    return spark.createDataFrame(rows, schema)


def values(df: DataFrame, column: str) -> list:
    return sorted(row[0] for row in df.select(column).collect())
