"""Bronze tables derived from the given tables.

The events are dirty on purpose: missing ids, blanks, mixed case, zero and
missing amounts, repeated event ids. ``testbed/oracles.py`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.ingest import to_records
from tillstream.schemas import ORDERS, EventSpec

# Bounds that suit the range of `events.value`, which stands in for a duration.
BUCKETS = (1, 5, 10, 25, 50, 100, 250)


# The columns read from the given tables; stating them saves a look at the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows with their part. Both sides grow, so neither is ever broadcast."""
    parts = table(spark, sf_dir, "part").hint("merge")
    return table(spark, sf_dir, "lineitem").join(parts, F.expr("l_partkey = p_partkey"))


def _select(df: DataFrame, **columns: str) -> DataFrame:
    """SQL expressions by column name."""
    return df.selectExpr(*[f"{expression} as {name}" for name, expression in columns.items()])


def _iso(moment: str) -> str:
    """A timestamp the way producers write it."""
    return f"concat(replace(cast({moment} as string), ' ', 'T'), '+00:00')"


def _record(moment: str, offset: str, partition: str) -> dict[str, str]:
    return {
        "kafka_offset": offset,
        "kafka_partition": f"cast({partition} as int)",
        "kafka_timestamp": f"cast({moment} as timestamp)",
        "ingested_at": f"cast({moment} as timestamp)",
    }


# The offset of a lineitem row: rows that share order and line differ in it.
_LINE_OFFSET = "(l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint)"


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order event per lineitem row."""
    # The customer side is joined first: it is the smaller one.
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    buyers = table(spark, sf_dir, "customer").join(places, F.expr("c_nationkey = n_nationkey"))
    orders = table(spark, sf_dir, "orders").join(buyers, F.expr("o_custkey = c_custkey"))
    # Both sides of this join grow together, so neither is ever broadcast.
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    )
    # Amounts in whole cents; the discount is rounded half up.
    lines = lines.selectExpr(
        "*",
        "o_orderdate + make_dt_interval(0, cast(l_orderkey % 24 as int), 0, 0) as ts",
        "cast(rint(l_extendedprice * 100) as bigint) % 60000 as base",
        "floor((base * cast(rint(l_discount * 100) as bigint) + 50) / 100) as disc",
    )
    return _select(
        lines,
        event_type="'order'",
        event_id="if(l_orderkey % 97 = 0, null, concat('EVT-', l_orderkey, '-', l_linenumber))",
        timestamp=_iso("ts"),
        order_id="if(l_orderkey % 101 = 0, null, concat('ORD-', o_orderkey))",
        customer_id="concat('  cust-', o_custkey, ' ')",
        region="concat(' ', r_name)",
        product="struct(concat('SKU-', p_partkey) as id, p_name as name, p_type as category, "
        "p_retailprice as unit_price)",
        quantity="cast(l_quantity as int)",
        subtotal="base / 100",
        discount_pct="l_discount",
        discount_amount="disc / 100",
        total_amount="case when l_partkey % 89 = 0 then null when l_partkey % 83 = 0 then 0D "
        "else (base - disc) / 100 end",
        currency="' usd'",
        payment_method="case o_orderpriority when '1-URGENT' then ' Credit_Card' "
        "when '2-HIGH' then 'PAYPAL ' else concat(' ', o_orderpriority) end",
        status="case o_orderstatus when 'F' then ' Completed' when 'O' then 'PENDING ' "
        "else 'failed' end",
        **_record("ts", _LINE_OFFSET, "l_orderkey % 3"),
        source_topic="'orders'",
    )


def bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One click event per events row."""
    events = table(spark, sf_dir, "events")
    item = "get_json_object(props, '$.k')"
    return _select(
        events,
        event_type="'click'",
        event_id="concat('CLK-', event_id - if(event_id % 11 = 0 and event_id > 0, 1, 0))",
        timestamp=_iso("ts"),
        session_id="if(event_id % 53 = 0, null, "
        "concat('SESS-', user_id, '-', date_format(ts, 'yyyyMMdd')))",
        customer_id="concat(' cust-', user_id)",
        region="concat(' zone ', user_id % 5, ' ')",
        product_id=f"if(event_id % 59 = 0, null, concat('SKU-', {item}))",
        product_name=f"concat('Item ', {item})",
        category="concat(' ', event_type, ' ')",
        page="if(event_type = 'view', ' Product_Detail', concat(upper(event_type), ' '))",
        added_to_cart="event_type in ('purchase', 'signup')",
        time_on_page_sec="cast(floor(value) as int) * if(event_id % 7 = 0, -1, 1)",
        **_record("ts", "event_id", "0"),
        source_topic="'clicks'",
    )


def bronze_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stock update per lineitem row."""
    lines = _lines_with_parts(spark, sf_dir)
    stock = "cast(l_quantity as int) * 10 - 10"
    return _select(
        lines,
        event_type="'inventory'",
        event_id="concat('INV-', l_orderkey, '-', l_linenumber)",
        timestamp=_iso("l_shipdate"),
        product_id="if(l_orderkey % 97 = 0, null, concat(' sku-', l_partkey))",
        product_name="p_name",
        warehouse_id="concat('wh-', l_suppkey % 10 + 1, ' ')",
        stock_level=f"case when l_partkey % 89 = 0 then -1 when l_partkey % 83 = 0 then null "
        f"else {stock} end",
        reorder_threshold="case when l_partkey % 7 = 0 then null "
        "else cast(20 + l_suppkey % 5 * 30 as int) end",
        low_stock_alert=f"{stock} < 50",
        action="case when l_partkey % 79 = 0 then 'Lost' when l_returnflag = 'R' then ' Return' "
        "when l_returnflag = 'A' then 'Adjustment' else 'SALE_DEDUCTION' end",
        **_record("l_shipdate", _LINE_OFFSET, "l_orderkey % 3"),
        source_topic="'inventory'",
    )


BRONZE = {"orders": bronze_orders, "clicks": bronze_clicks, "inventory": bronze_inventory}


def topic_records(bronze: DataFrame, spec: EventSpec) -> DataFrame:
    """The events as a topic source delivers them."""
    events = spec.schema.names
    record = ["kafka_offset", "kafka_partition", "kafka_timestamp"]
    records = to_records(bronze.select(*events, *record), spec.key_columns, keep=record)
    return records.select(
        "key",
        "value",
        F.lit(spec.topic()).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row with price, quantity, discount rate and stored amounts.

    Prices are in tenths of a cent, and are rounded with the quantity only. The amounts
    are made in whole cents, with one error of each kind put in at a rate of its own.
    """
    lines = _lines_with_parts(spark, sf_dir).selectExpr(
        "*",
        f"{_LINE_OFFSET} as kafka_offset",
        "cast(rint(p_retailprice * 100) as bigint) * 10 + l_partkey % 10 as mills",
        "floor((mills * cast(l_quantity as int) + 5) / 10) as sub",
        "floor((sub * cast(rint(l_discount * 100) as bigint) + 50) / 100) as disc",
    )
    return _select(
        lines,
        event_id="concat('EVT-', l_orderkey, '-', l_linenumber)",
        kafka_offset="kafka_offset",
        product="struct(mills / 1000 as unit_price)",
        quantity="cast(l_quantity as int)",
        discount_pct="l_discount",
        subtotal="if(kafka_offset % 13 = 0, sub + 1, sub) / 100",
        discount_amount="if(kafka_offset % 17 = 0, null, disc) / 100",
        total_amount="if(kafka_offset % 19 = 0, 100, sub - disc) / 100",
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per events row."""
    return _select(
        table(spark, sf_dir, "events"),
        ts="cast(ts as timestamp)",
        method="'GET'",
        endpoint="event_type",
        status="if(event_type = 'error', 500, 200)",
        duration_sec="value",
        operation="if(event_type = 'error', 'query', null)",
    )


def scraped_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample of a counter per events row; it restarts, and some scrapes are missing."""
    samples = table(spark, sf_dir, "events").filter("event_id % 1000 not between 300 and 400")
    return _select(
        samples, ts="cast(ts as timestamp)", endpoint="event_type", value="cast(event_id % 997 as double)"
    )


def drifted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records with fields that the contract does not name, and a quantity in words."""
    events = bronze_orders(spark, sf_dir)
    drifted = events.selectExpr(
        "* except (quantity, product)",
        "if(kafka_offset % 10 = 3, 'two', cast(quantity as string)) as quantity",
        "struct(product.*, if(kafka_offset % 4 = 1, 'own', null) as brand) as product",
        "if(kafka_offset % 5 = 2, concat('C', kafka_offset % 7), null) as coupon",
        "if(kafka_offset % 3 = 0, kafka_offset % 2 = 0, null) as gift",
    )
    record = ["kafka_offset", "kafka_partition", "kafka_timestamp"]
    fields = [*ORDERS.schema.names, "coupon", "gift"]
    records = to_records(drifted.select(*fields, *record), ORDERS.key_columns, keep=record)
    return records.select(
        "key",
        "value",
        F.lit(ORDERS.topic()).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
