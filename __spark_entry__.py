"""Registered queries and the SQL each must equal.

Every query reads the given tables whole, sees them as bronze events
(``testbed/events.py``) and runs the library's operators on them. Processing-time
columns are left out: they differ from run to run.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from pathlib import Path
from types import ModuleType

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from testbed import events as E  # noqa: E402
from testbed import oracles  # noqa: E402
from tillstream import session  # noqa: E402
from tillstream.operators import amounts, documents, ingest, serving, validation  # noqa: E402
from tillstream.operators import kpis as K  # noqa: E402
from tillstream.operators import counters, drift, quantiles, sketches  # noqa: E402
from tillstream.operators import request_log as R  # noqa: E402
from tillstream.operators.cleaning import CLEANERS  # noqa: E402
from tillstream.schemas import EVENT_TYPES, ORDERS  # noqa: E402


def _if_present(name: str, owner: str) -> ModuleType | None:
    """The module, or None where it or its package ``owner`` has been taken out."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name not in (name, owner):
            raise
        return None


# The text operators are optional: the engine works without them.
TEXT = _if_present("tillstream.llm.queries", "tillstream.llm")
corpus_pipeline = _if_present("corpus_pipeline", "tillstream.llm")

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
DAY_BEFORE = datetime(2024, 1, 30, tzinfo=timezone.utc)
PROCESSING_TIMES = ("ingested_at", "silver_processed_at", "computed_at")

Query = Callable[[SparkSession, str], DataFrame]


def _shown(df: DataFrame) -> DataFrame:
    """Comparable columns: no processing times, no nesting, timestamps without a zone."""
    columns = []
    for field in df.schema.fields:
        if field.name in PROCESSING_TIMES or field.name == "_raw":
            continue
        if field.name == "product":
            parts = {"id": "product_id", "name": "product_name", "category": "category"}
            columns += [F.col(f"product.{k}").alias(v) for k, v in parts.items()]
            columns.append(F.col("product.unit_price").alias("unit_price"))
        elif isinstance(field.dataType, T.TimestampType):
            columns.append(F.col(field.name).cast("timestamp_ntz").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def _bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return E.BRONZE[name](spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return CLEANERS[name](_bronze(spark, sf_dir, name))[0]


def _summary(spark: SparkSession, sf_dir: str, day: datetime) -> DataFrame:
    orders, clicks = (_silver(spark, sf_dir, n) for n in ("orders", "clicks"))
    return K.summary(orders, clicks, as_of=day, computed_at=day)


def _stored(spark: SparkSession, sf_dir: str, kpi_type: str) -> dict[str, DataFrame]:
    """One KPI as it is stored; the summary holds two days."""

    def silver(name: str) -> DataFrame:
        return _silver(spark, sf_dir, name)

    if kpi_type == "summary":
        days = [_summary(spark, sf_dir, day) for day in (DAY_BEFORE, AS_OF)]
        return {"summary": documents.upsert_kpis(*days)}
    kpi = {
        "hourly_revenue": lambda: K.hourly_revenue(silver("orders"), AS_OF),
        "products": lambda: K.product_revenue(silver("orders"), AS_OF),
        "conversion": lambda: K.conversion_funnel(silver("orders"), silver("clicks"), AS_OF),
        "inventory": lambda: K.inventory_status(silver("inventory"), AS_OF),
    }[kpi_type]()
    return {kpi_type: documents.with_doc_id(kpi, kpi_type)}


# ── Layers ───────────────────────────────────────────────────────────────────
def _through_topic(name: str) -> Query:
    """Encode as topic records, decode as bronze."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = EVENT_TYPES[name]
        return ingest.to_bronze(E.topic_records(_bronze(spark, sf_dir, name), spec), spec)

    return query


def _cleaned(name: str) -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir, name)


def _quarantined(name: str) -> Query:
    return lambda spark, sf_dir: CLEANERS[name](_bronze(spark, sf_dir, name))[1]


def quarantine_orders_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = validation.split_valid(_bronze(spark, sf_dir, "orders"), ORDERS, detail=True)
    rules = F.concat_ws(",", "failed_rules").alias("failed_rules")
    return rejected.select("event_id", "kafka_offset", "kafka_partition", rules)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer and event type; bronze = valid + quarantine."""
    counts = [
        validation.layer_counts(_bronze(spark, sf_dir, name), spec).select(
            F.lit(name).alias("event_type"), "*"
        )
        for name, spec in EVENT_TYPES.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _values_checked(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wrong = validation.check_values(_bronze(spark, sf_dir, name), EVENT_TYPES[name])
        columns = F.concat_ws(",", "wrong_values").alias("wrong_values")
        return wrong.select("event_id", "kafka_offset", "kafka_partition", columns)

    return query


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of order records that the contract does not name or cannot read."""
    bronze = ingest.to_bronze(E.drifted_records(spark, sf_dir), ORDERS)
    return drift.drift_report(bronze, ORDERS)


def drifted_coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field the contract does not name, read back from the raw records."""
    bronze = ingest.to_bronze(E.drifted_records(spark, sf_dir), ORDERS)
    fields = {"coupon": ("coupon", "string"), "product_brand": ("product.brand", "string")}
    found = drift.with_raw_fields(bronze, fields)
    return found.filter(F.col("coupon").isNotNull()).groupBy("coupon", "product_brand").agg(
        F.count("*").alias("orders")
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per key, with units read back from the encoded value."""
    records = E.topic_records(_bronze(spark, sf_dir, "orders"), ORDERS)
    units = F.get_json_object(F.col("value").cast("string"), "$.quantity").cast("bigint")
    return records.groupBy(F.trim(F.col("key").cast("string")).alias("record_key")).agg(
        F.count("*").alias("records"), F.sum(units).alias("units")
    )


# ── KPIs ─────────────────────────────────────────────────────────────────────
def _kpi(build: Callable[..., DataFrame], *inputs: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(*[_silver(spark, sf_dir, n) for n in inputs], **options)

    return query


def _read(kpi_type: str, read: Callable[..., DataFrame], *args, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(_stored(spark, sf_dir, kpi_type), *args, **options)

    return query


def revenue_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = serving.get_revenue(_stored(spark, sf_dir, "hourly_revenue"), region="ASIA", limit=24)
    whole = serving.envelope(page, region_filter="ASIA")
    orders = F.aggregate("data", F.lit(0).cast("bigint"), lambda n, row: n + row["order_count"])
    return whole.select(
        "status",
        "count",
        "region_filter",
        F.array_join(F.col("data.id"), ",").alias("ids"),
        orders.alias("orders"),
    )


def kpi_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored stock levels, with the shelves that are low now brought up to date."""
    inventory = _silver(spark, sf_dir, "inventory")
    stored = documents.with_doc_id(K.inventory_status(inventory, DAY_BEFORE), "inventory")
    low_now = K.inventory_latest(inventory, AS_OF).filter("low_stock_alert")
    return documents.upsert_kpis(stored, documents.with_doc_id(low_now, "inventory"))


def kpi_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly revenue encoded as JSON documents, with fields read back."""
    kpi = K.hourly_revenue(_silver(spark, sf_dir, "orders"), AS_OF)
    docs = documents.to_documents(kpi, "hourly_revenue")
    fields = (
        "hour_bucket string, region string, revenue double, order_count long, "
        "avg_order_value double, total_discounts double, unique_customers long"
    )
    return docs.select("kpi_type", "id", F.from_json("doc", fields).alias("d")).select(
        "kpi_type", "id", "d.*"
    )


# ── Amounts ──────────────────────────────────────────────────────────────────
def order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = amounts.derive_order_amounts(E.priced_orders(spark, sf_dir))
    return priced.select(
        "event_id", "kafka_offset", "subtotal", "discount_amount", "total_amount"
    )


def order_amount_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = amounts.check_amounts(E.priced_orders(spark, sf_dir))
    return wrong.select("event_id", "kafka_offset", "subtotal_ok", "discount_ok", "total_ok")


def low_stock_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = amounts.check_low_stock(_bronze(spark, sf_dir, "inventory"))
    return wrong.select("event_id", "kafka_offset", "stock_level", "low_stock_alert")


# ── Request log ──────────────────────────────────────────────────────────────
def _log(rollup: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf_dir: rollup(E.request_log(spark, sf_dir), *args, **options)


def error_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = R.error_rate(E.request_log(spark, sf_dir))
    return R.classify(rate, "error_pct", R.ERROR_RATE_STEPS)


def store_errors_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = R.store_errors(E.request_log(spark, sf_dir))
    return R.classify(errors, "requests", R.STORE_ERROR_STEPS)


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.latency_histogram(E.request_log(spark, sf_dir), E.BUCKETS)
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return found.withColumn("le", le)


def latency_quantiles(**options: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = R.latency_quantiles(E.request_log(spark, sf_dir), buckets=E.BUCKETS, **options)
        return found.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})

    return query


def exact_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quantiles.exact_quantiles(E.request_log(spark, sf_dir), window="1 hour")
    return found.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})


def sketched_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quantiles of merged sketches are as near as stated, per window."""
    log = E.request_log(spark, sf_dir)
    steps = sketches.latency_sketches(log, "10 minutes")
    found = sketches.sketched_quantiles(steps, window="1 day", slide="6 hours")
    days = log.select(R.windowed("ts", "1 day", "6 hours"), "duration_sec").select(
        F.col("window.start").alias("window_start"), "duration_sec"
    )
    ranks = days.join(found, "window_start").groupBy("window_start", "window_end", "requests")
    names = {f"p{round(100 * q)}": q for q in R.QUANTILES}
    ranks = ranks.agg(
        *[(F.count_if(F.col("duration_sec") < F.col(p)) / F.count("*")).alias(f"{p}_under") for p in names],
        *[(F.count_if(F.col("duration_sec") <= F.col(p)) / F.count("*")).alias(f"{p}_upto") for p in names],
    )
    near = [
        (F.col(f"{p}_under") <= q + sketches.RANK_ERROR) & (F.col(f"{p}_upto") >= q - sketches.RANK_ERROR)
        for p, q in names.items()
    ]
    return ranks.select(
        "window_start", "window_end", "requests", reduce(Column.__and__, near).alias("within_bound")
    )


def customers_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per day and region: the count, and whether merged sketches are near it."""
    orders = _silver(spark, sf_dir, "orders")
    day = F.to_date("hour_bucket")
    merged = sketches.distinct_customers(
        sketches.customer_sketches(orders), by={"day": day, "region": F.col("region")}
    ).withColumnRenamed("customers", "_estimate")
    counted = K.completed(orders).groupBy(F.to_date("event_ts").alias("day"), "region").agg(
        F.count_distinct("customer_id").alias("customers")
    )
    error = F.abs(F.col("_estimate") - F.col("customers"))
    return counted.join(merged, ["day", "region"]).select(
        "day",
        "region",
        "customers",
        (error <= sketches.CUSTOMER_ERROR * F.col("customers")).alias("within_bound"),
    )


def _counter(**options: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = counters.increase(E.scraped_counters(spark, sf_dir), ["endpoint"], **options)
        return found.withColumns({c: F.round(c, 6) for c in ("increase", "per_second")})

    return query


_QUERIES: dict[str, Query] = {
    **{f"bronze_{n}": _through_topic(n) for n in EVENT_TYPES},
    **{f"silver_{n}": _cleaned(n) for n in EVENT_TYPES},
    **{f"quarantine_{n}": _quarantined(n) for n in EVENT_TYPES},
    "quarantine_orders_rules": quarantine_orders_rules,
    "layer_counts": layer_counts,
    "order_records": order_records,
    "schema_drift": schema_drift,
    "drifted_coupons": drifted_coupons,
    "hourly_revenue": _kpi(K.hourly_revenue, "orders"),
    "top_products": _kpi(K.top_products, "orders"),
    "conversion_funnel": _kpi(K.conversion_funnel, "orders", "clicks"),
    "summary": _kpi(K.summary, "orders", "clicks", as_of=AS_OF),
    "inventory_status": _kpi(K.inventory_status, "inventory"),
    "inventory_latest": _kpi(K.inventory_latest, "inventory"),
    "kpi_summary": _read("summary", serving.get_summary),
    "kpi_conversion": _read("conversion", serving.get_conversion),
    "revenue_latest_hours": _read("hourly_revenue", serving.get_revenue),
    "revenue_by_region": _read("hourly_revenue", serving.get_revenue, region="EUROPE", limit=24),
    "product_revenue": _kpi(K.product_revenue, "orders"),
    "products_by_revenue": _read("products", serving.get_products, limit=5),
    "products_by_category": _read("products", serving.get_products, category="PROMO"),
    "products_top_50": _read("products", serving.get_products, limit=50),
    "inventory_alerts": _read("inventory", serving.get_inventory),
    "inventory_lowest": _read("inventory", serving.get_inventory, alerts_only=False, limit=200),
    "regions": _read("hourly_revenue", serving.get_regions),
    "kpi_query": _read("inventory", serving.query_kpis, "inventory", {"warehouse_id": "WH-3"}),
    "kpi_item": _read("conversion", serving.get_item, "conversion", "conversion"),
    "revenue_envelope": revenue_envelope,
    "kpi_upsert": kpi_upsert,
    "kpi_documents": kpi_documents,
    "order_amounts": order_amounts,
    "order_amount_check": order_amount_check,
    "low_stock_check": low_stock_check,
    "order_value_check": _values_checked("orders"),
    "click_value_check": _values_checked("clicks"),
    "stock_value_check": _values_checked("inventory"),
    "request_counts_5m": _log(R.request_counts),
    "request_counts_sliding": _log(R.request_counts, slide="1 minute"),
    "error_rate_5m": _log(R.error_rate),
    "error_rate_sliding": _log(R.error_rate, slide="1 minute"),
    "error_band": error_band,
    "store_errors_5m": _log(R.store_errors),
    "store_errors_band": store_errors_band,
    "request_rate_1m": _log(R.request_rate),
    "latency_histogram": latency_histogram,
    "latency_quantiles": latency_quantiles(),
    "latency_quantiles_sliding": latency_quantiles(slide="1 minute"),
    "status_breakdown": _log(R.status_breakdown),
    "exact_latency": exact_latency,
    "sketched_latency": sketched_latency,
    "customers_by_day": customers_by_day,
    "counter_increase": _counter(window="6 hours", block="1 hour"),
    "counter_increase_sliding": _counter(window="12 hours", slide="3 hours", block="1 day"),
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: _shown(query(session.pin(spark), sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Hourly revenue by region, from raw events through silver."""
    return queries()["hourly_revenue"](spark, SMOKE_DIR)


def core_queries() -> dict[str, Query]:
    """The engine's own queries; each has SQL."""
    return {name: _registered(query) for name, query in _QUERIES.items()}


def queries() -> dict[str, Query]:
    found = core_queries()
    if TEXT is not None:
        found |= TEXT.QUERIES
    if corpus_pipeline is not None:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql(E.BUCKETS, AS_OF.strftime("%Y-%m-%d"))
    if TEXT is not None:
        found |= TEXT.SQL
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
