"""Event contracts: what each event type looks like and what makes it valid."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class LowerBound:
    """The column must be above ``limit`` (or equal to it when ``inclusive``)."""

    column: str
    limit: float
    inclusive: bool = False


@dataclass(frozen=True)
class EventSpec:
    """Everything the layers need to know about one event type.

    ``text_rules`` maps a column to a case rule of :mod:`tillstream.functions.text`;
    ``key_columns`` are tried in order for the topic record key. ``allowed`` names the
    values a column may have once its text rule has been applied.
    """

    name: str
    schema: T.StructType
    required: tuple[str, ...]
    text_rules: Mapping[str, str]
    quarantine_reason: str
    key_columns: tuple[str, ...]
    bound: LowerBound | None = None
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    silver_partition: str = "source_topic"

    def topic(self, prefix: str = "") -> str:
        return f"{prefix}{self.name}"

    @property
    def bronze_schema(self) -> T.StructType:
        """Event fields plus ingestion columns, for reads that must not sample files."""
        return T.StructType(self.schema.fields + INGESTION_FIELDS)

    @property
    def bronze_table_schema(self) -> T.StructType:
        """The stored table: bronze rows by the day they arrived."""
        return self.bronze_schema.add(ARRIVAL_DATE, "date")

    @property
    def quarantine_schema(self) -> T.StructType:
        rules = T.StructField("failed_rules", T.ArrayType(T.StringType()))
        fields = [*self.bronze_schema.fields, T.StructField("quarantine_reason", T.StringType()), rules]
        return T.StructType(fields).add(ARRIVAL_DATE, "date")

    @property
    def silver_partitions(self) -> tuple[str, str]:
        return self.silver_partition, EVENT_DATE


# Partitions: the day a record arrived finds what is new, the day of the event what
# a query needs.
ARRIVAL_DATE, EVENT_DATE = "arrival_date", "event_date"

# Columns added on the way into bronze. `_raw` keeps the record as it arrived.
INGESTION_FIELDS = [
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("_raw", T.StringType()),
]


def _schema(**fields: str | T.StructType) -> T.StructType:
    schema = T.StructType()
    for name, data_type in fields.items():
        schema = schema.add(name, data_type)
    return schema


# The wire formats of the three event types.
ORDER_SCHEMA = _schema(
    event_type="string",
    event_id="string",
    timestamp="string",
    order_id="string",
    customer_id="string",
    region="string",
    product=_schema(id="string", name="string", category="string", unit_price="double"),
    quantity="integer",
    subtotal="double",
    discount_pct="double",
    discount_amount="double",
    total_amount="double",
    currency="string",
    payment_method="string",
    status="string",
)
CLICK_SCHEMA = _schema(
    event_type="string",
    event_id="string",
    timestamp="string",
    session_id="string",
    customer_id="string",
    region="string",
    product_id="string",
    product_name="string",
    category="string",
    page="string",
    added_to_cart="boolean",
    time_on_page_sec="integer",
)
INVENTORY_SCHEMA = _schema(
    event_type="string",
    event_id="string",
    timestamp="string",
    product_id="string",
    product_name="string",
    warehouse_id="string",
    stock_level="integer",
    reorder_threshold="integer",
    low_stock_alert="boolean",
    action="string",
)

# What a source must deliver: the columns of a topic record.
TOPIC_SCHEMA = _schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
)

# What producers send.
REGIONS = ("North America", "Europe", "Asia Pacific", "Latin America", "Middle East")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "apple_pay", "google_pay")
STATUSES = ("completed", "pending", "failed")
CURRENCIES = ("USD",)
PAGES = ("product_detail", "search_results", "homepage", "category")
ACTIONS = ("restock", "sale_deduction", "adjustment", "return")

ORDERS = EventSpec(
    name="orders",
    schema=ORDER_SCHEMA,
    required=("event_id", "order_id", "customer_id", "status"),
    bound=LowerBound("total_amount", 0.0),
    text_rules={
        "customer_id": "upper",
        "currency": "upper",
        "status": "lower",
        "payment_method": "lower",
        "region": "keep",
    },
    quarantine_reason="missing_required_fields_or_invalid_amount",
    key_columns=("customer_id",),
    allowed={
        "region": REGIONS,
        "currency": CURRENCIES,
        "payment_method": PAYMENT_METHODS,
        "status": STATUSES,
    },
    silver_partition="status",
)

CLICKS = EventSpec(
    name="clicks",
    schema=CLICK_SCHEMA,
    required=("event_id", "session_id", "product_id"),
    text_rules={
        "customer_id": "upper",
        "page": "lower",
        "region": "keep",
        "category": "keep",
    },
    quarantine_reason="missing_required_click_fields",
    key_columns=("customer_id", "product_id"),
    allowed={"region": REGIONS, "page": PAGES},
)

INVENTORY = EventSpec(
    name="inventory",
    schema=INVENTORY_SCHEMA,
    required=("event_id", "product_id"),
    bound=LowerBound("stock_level", 0, inclusive=True),
    text_rules={"product_id": "upper", "warehouse_id": "upper", "action": "lower"},
    quarantine_reason="invalid_inventory_event",
    key_columns=("product_id",),
    allowed={"action": ACTIONS},
)

EVENT_TYPES: dict[str, EventSpec] = {spec.name: spec for spec in (ORDERS, CLICKS, INVENTORY)}

# One typed table per KPI; the columns that make a row of it unique.
KPI_KEYS: dict[str, tuple[str, ...]] = {
    "hourly_revenue": ("hour_bucket", "region"),
    "products": ("product_id", "product_name", "category"),
    "top_products": ("product_id", "product_name", "category"),
    "conversion": (),
    "inventory": ("product_id", "product_name", "warehouse_id"),
    "summary": ("computed_date",),
}

# KPIs of which each run gives the whole current state: a row that is gone is gone. The
# others hold a row per hour or day, and old ones stay.
SNAPSHOT_KPIS = ("products", "top_products", "conversion", "inventory")

KPI_SCHEMAS: dict[str, T.StructType] = {
    "hourly_revenue": _schema(
        hour_bucket="timestamp",
        region="string",
        revenue="double",
        order_count="long",
        avg_order_value="double",
        total_discounts="double",
        unique_customers="long",
        kpi_type="string",
        computed_at="timestamp",
        id="string",
    ),
    "products": _schema(
        product_id="string",
        product_name="string",
        category="string",
        revenue="double",
        units_sold="long",
        avg_order_value="double",
        order_count="long",
        kpi_type="string",
        computed_at="timestamp",
        id="string",
    ),
    "top_products": _schema(
        product_id="string",
        product_name="string",
        category="string",
        revenue="double",
        units_sold="long",
        avg_order_value="double",
        order_count="long",
        rank="integer",
        kpi_type="string",
        computed_at="timestamp",
        id="string",
    ),
    "conversion": _schema(
        total_clicks="long",
        added_to_cart="long",
        completed_orders="long",
        conversion_rate_pct="double",
        cart_abandonment_pct="double",
        add_to_cart_rate_pct="double",
        kpi_type="string",
        computed_at="timestamp",
        id="string",
    ),
    "inventory": _schema(
        product_id="string",
        product_name="string",
        warehouse_id="string",
        current_stock="integer",
        reorder_threshold="integer",
        low_stock_alert="boolean",
        kpi_type="string",
        computed_at="timestamp",
        id="string",
    ),
    "summary": _schema(
        id="string",
        total_revenue="double",
        total_orders="long",
        avg_order_value="double",
        total_clicks="long",
        computed_date="string",
        kpi_type="string",
        computed_at="timestamp",
    ),
}
