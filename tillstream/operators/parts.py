"""KPIs in parts by event date, and the KPIs that the parts add up to.

A part depends on one date only, so after a change only the parts of the dates that changed
are made again. Sums and counts of parts are added, maxima are compared.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import money
from tillstream.operators import kpis as K
from tillstream.schemas import EVENT_DATE

PRODUCT = ("product_id", "product_name", "category")
SHELF = ("product_id", "product_name", "warehouse_id")
# The parts made of each event type.
PART_TYPES: Mapping[str, tuple[str, ...]] = {
    "orders": ("hours", "product_days", "order_days"),
    "clicks": ("click_days",),
    "inventory": ("shelf_days",),
}


def _amounts() -> list[Column]:
    return [
        F.sum(money("total_amount")).alias("amount"),
        F.count(money("total_amount")).alias("amounts"),
        F.count("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
    ]


def build_parts(silver: DataFrame, event_type: str) -> dict[str, DataFrame]:
    """The parts of the dates that the silver rows are of, by name."""
    day = F.col(EVENT_DATE)
    if event_type == "orders":
        sold = K.completed(silver)
        product = [F.col(f"product.{f}").alias(n) for f, n in zip(("id", "name", "category"), PRODUCT)]
        # An hour lies within one date, so hours are whole in their part.
        hours = K.hourly_revenue(silver).drop("kpi_type", "computed_at")
        return {
            "hours": hours.withColumn(EVENT_DATE, F.to_date("hour_bucket")),
            "product_days": sold.groupBy(day, *product).agg(*_amounts()),
            "order_days": sold.groupBy(day).agg(*_amounts(), F.count("*").alias("rows")),
        }
    if event_type == "clicks":
        carts = F.count_if(F.col("added_to_cart")).alias("carts")
        return {"click_days": silver.groupBy(day).agg(F.count("*").alias("clicks"), carts)}
    highest = [F.max(c).alias(c) for c in ("stock_level", "reorder_threshold", "low_stock_alert")]
    return {"shelf_days": silver.groupBy(day, *SHELF).agg(*highest)}


def combine(parts: Mapping[str, DataFrame], as_of: datetime | None = None) -> dict[str, DataFrame]:
    """The KPIs of all dates, by KPI type; equal to those made from all of silver."""
    amount, amounts = F.sum("amount"), F.sum("amounts")
    products = parts["product_days"].groupBy(*PRODUCT).agg(
        F.round(amount, 2).cast("double").alias("revenue"),
        F.sum("units").alias("units_sold"),
        F.round(amount / amounts, 2).cast("double").alias("avg_order_value"),
        F.sum("orders").alias("order_count"),
    )
    leaders = K.rank_products(products, K.TOP_PRODUCTS)
    sold = parts["order_days"].agg(
        amount.alias("revenue"),
        F.coalesce(amounts, F.lit(0)).alias("amounts"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("completed_orders"),
    )
    clicked = parts["click_days"].agg(
        F.coalesce(F.sum("clicks"), F.lit(0)).alias("total_clicks"),
        F.coalesce(F.sum("carts"), F.lit(0)).alias("added_to_cart"),
    )
    # One row each.
    totals = sold.withColumn("_one", F.lit(1)).join(clicked.withColumn("_one", F.lit(1)), "_one")
    shelves = parts["shelf_days"].groupBy(*SHELF).agg(
        F.max("stock_level").alias("current_stock"),
        F.max("reorder_threshold").alias("reorder_threshold"),
        F.max("low_stock_alert").alias("low_stock_alert"),
    )
    return {
        "hourly_revenue": K.tagged(parts["hours"].drop(EVENT_DATE), "hourly_revenue", as_of),
        "products": K.tagged(products, "products", as_of),
        "top_products": K.tagged(leaders, "top_products", as_of),
        "conversion": K.funnel_of(totals, as_of),
        "inventory": K.tagged(shelves, "inventory", as_of),
        "summary": K.summary_of(totals, as_of, as_of),
    }
