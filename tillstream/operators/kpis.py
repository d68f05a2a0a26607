"""Silver -> gold: the five business KPIs.

Every KPI is one lazy plan ending in a small table; no value passes the driver.
``kpi_type`` is the name the KPI is stored and queried under.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.functions.money import MONEY_TYPE, money, money_mean, money_sum, percent
from tillstream.functions.times import processing_time
from tillstream.operators.cleaning import stamp

# Fixed value: how many products lead.
TOP_PRODUCTS = 10


def completed(orders: DataFrame) -> DataFrame:
    """Completed orders; on the silver table this prunes to one partition."""
    return orders.filter(F.col("status") == "completed")


def tagged(kpi: DataFrame, kpi_type: str, at: datetime | None = None) -> DataFrame:
    """A KPI with the name it is stored under and the time it was computed."""
    return stamp(kpi.withColumn("kpi_type", F.lit(kpi_type)), "computed_at", at)


def hourly_revenue(
    orders: DataFrame,
    computed_at: datetime | None = None,
    estimate_customers: bool = False,
    late: str | None = None,
) -> DataFrame:
    """Revenue, orders, mean order, discounts and distinct customers per hour and region.

    Customers are counted exactly, which a stream cannot do: there
    ``estimate_customers`` must be set, for an approximate count under the same name.
    ``late`` is the watermark of a stream; an hour is forgotten once it has passed it.
    """
    distinct = F.approx_count_distinct if estimate_customers else F.count_distinct
    hour = F.date_trunc("hour", F.col("event_ts")).alias("hour_bucket")
    rows = completed(orders)
    if late is not None:
        # Spark forgets windows that the watermark has passed, but not what is made of them.
        rows = rows.withWatermark("event_ts", late)
        hour = F.window("event_ts", "1 hour").alias("hour_bucket")
    kpi = (
        rows.groupBy(hour, "region")
        .agg(
            money_sum("total_amount").alias("revenue"),
            F.count("order_id").alias("order_count"),
            money_mean("total_amount").alias("avg_order_value"),
            money_sum("discount_amount").alias("total_discounts"),
            distinct("customer_id").alias("unique_customers"),
        )
    )
    if late is not None:
        kpi = kpi.withColumn("hour_bucket", F.col("hour_bucket.start"))
    return tagged(kpi, "hourly_revenue", computed_at)


def _product_sales(orders: DataFrame) -> DataFrame:
    return (
        completed(orders)
        .groupBy(
            F.col("product.id").alias("product_id"),
            F.col("product.name").alias("product_name"),
            F.col("product.category").alias("category"),
        )
        .agg(
            money_sum("total_amount").alias("revenue"),
            F.sum("quantity").alias("units_sold"),
            money_mean("total_amount").alias("avg_order_value"),
            F.count("order_id").alias("order_count"),
        )
    )


def product_revenue(orders: DataFrame, computed_at: datetime | None = None) -> DataFrame:
    """Revenue, units and orders of every product."""
    return tagged(_product_sales(orders), "products", computed_at)


def rank_products(products: DataFrame, n: int) -> DataFrame:
    """The ``n`` products with the highest revenue, ranked; ties go by product keys."""
    leaders_first = [F.desc_nulls_last("revenue"), "product_id", "product_name", "category"]
    leaders = products.orderBy(*leaders_first).limit(n)
    # At most n rows are left here, already in one partition.
    return leaders.withColumn("rank", F.row_number().over(Window.orderBy(*leaders_first)))


def top_products(
    orders: DataFrame, n: int = TOP_PRODUCTS, computed_at: datetime | None = None
) -> DataFrame:
    """The ``n`` leading products."""
    return tagged(rank_products(_product_sales(orders), n), "top_products", computed_at)


def _counted(rows: DataFrame, **measures: Column) -> DataFrame:
    return rows.select(*[measure.alias(name) for name, measure in measures.items()])


def order_click_totals(orders: DataFrame, clicks: DataFrame) -> DataFrame:
    """One row, from one pass over both tables: what funnel and summary are made of."""
    one, none = F.lit(1), F.lit(None).cast("int")
    sold = _counted(
        completed(orders), amount=money("total_amount"), click=none, cart=none, sale=one
    )
    clicked = _counted(
        clicks,
        amount=F.lit(None).cast(MONEY_TYPE),
        click=one,
        cart=F.when(F.col("added_to_cart"), one),
        sale=none,
    )
    return sold.unionByName(clicked).agg(
        F.sum("amount").alias("revenue"),
        F.count("amount").alias("amounts"),
        F.count("click").alias("total_clicks"),
        F.count("cart").alias("added_to_cart"),
        F.count("sale").alias("completed_orders"),
    )


def funnel_of(totals: DataFrame, computed_at: datetime | None = None) -> DataFrame:
    """The funnel from `order_click_totals`.

    Abandonment is not clamped: it is negative when more orders complete than
    carts were seen.
    """
    clicks_n, carts_n, sales_n = (
        F.col(c) for c in ("total_clicks", "added_to_cart", "completed_orders")
    )
    rates = totals.select(
        clicks_n,
        carts_n,
        sales_n,
        percent(sales_n, clicks_n).alias("conversion_rate_pct"),
        percent(carts_n - sales_n, carts_n).alias("cart_abandonment_pct"),
        percent(carts_n, clicks_n).alias("add_to_cart_rate_pct"),
    )
    return tagged(rates, "conversion", computed_at)


def summary_of(
    totals: DataFrame, as_of: datetime | None = None, computed_at: datetime | None = None
) -> DataFrame:
    """The day's summary from `order_click_totals`."""
    day = processing_time(as_of)
    # The mean is over the amounts that were added up, as in the other KPIs.
    mean = F.round(F.col("revenue") / F.col("amounts"), 2).cast("double")
    revenue = F.round("revenue", 2).cast("double")
    kpi = totals.select(
        F.concat(F.lit("summary_"), F.date_format(day, "yyyyMMdd")).alias("id"),
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue"),
        F.col("completed_orders").alias("total_orders"),
        F.when(F.col("amounts") > 0, mean).otherwise(F.lit(0.0)).alias("avg_order_value"),
        "total_clicks",
        F.date_format(day, "yyyy-MM-dd").alias("computed_date"),
    )
    return tagged(kpi, "summary", computed_at)


def conversion_funnel(
    orders: DataFrame, clicks: DataFrame, computed_at: datetime | None = None
) -> DataFrame:
    """Clicks, cart adds, completed orders and the rates between them, in one row."""
    return funnel_of(order_click_totals(orders, clicks), computed_at)


def summary(
    orders: DataFrame,
    clicks: DataFrame,
    as_of: datetime | None = None,
    computed_at: datetime | None = None,
) -> DataFrame:
    """Revenue, orders, mean order and clicks over everything, in one row per day."""
    return summary_of(order_click_totals(orders, clicks), as_of, computed_at)


def inventory_status(inventory: DataFrame, computed_at: datetime | None = None) -> DataFrame:
    """Highest stock, highest threshold and whether an alert was ever on, per shelf."""
    kpi = inventory.groupBy("product_id", "product_name", "warehouse_id").agg(
        F.max("stock_level").alias("current_stock"),
        F.max("reorder_threshold").alias("reorder_threshold"),
        F.max("low_stock_alert").alias("low_stock_alert"),
    )
    return tagged(kpi, "inventory", computed_at)


def inventory_latest(inventory: DataFrame, computed_at: datetime | None = None) -> DataFrame:
    """The same columns as `inventory_status`, taken from each shelf's last update.

    The last is the one with the greatest time, then offset, then partition; an update
    without a time comes before all others. Any time, offset and partition will do.
    """
    keys = ["product_id", "product_name", "warehouse_id"]
    wanted = ["stock_level", "reorder_threshold", "low_stock_alert"]
    # First the last place in each moment, then the last moment of each shelf: sort keys of
    # fixed width, so rows are aggregated by hash both times.
    offset, partition = (
        F.coalesce(F.col(c), F.lit(0)).cast("decimal(19,0)")
        for c in ("kafka_offset", "kafka_partition")
    )
    place = offset * F.lit(2**31).cast("decimal(11,0)") + partition
    earliest = F.lit(-(2**63)).cast("bigint")
    moment = F.coalesce(F.unix_micros("event_ts"), earliest)
    placed = inventory.select(*keys, *wanted, moment.alias("_moment"), place.alias("_place"))

    def latest(rows: DataFrame, by: list[str], order: str) -> DataFrame:
        return rows.groupBy(*by).agg(*[F.max_by(c, order).alias(c) for c in wanted])

    last = latest(latest(placed, [*keys, "_moment"], "_place"), keys, "_moment")
    last = last.withColumnRenamed("stock_level", "current_stock")
    return tagged(last, "inventory", computed_at)
