"""Reads over the stored KPIs.

``kpis`` maps a KPI type to its table. Limits outside the stated bounds raise
ValueError. Rows are always sorted before they are limited, and the sort ends in
the row keys, so a limit returns the same rows every time. Sorting and limiting
together keep only the wanted rows in each task; nothing is sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.kpis import rank_products

Kpis = Mapping[str, DataFrame]

# The stock an item without a stock level sorts by.
MISSING_STOCK = 999
# The most rows a read by type, or an envelope, returns.
MOST_ROWS = 1000


def _bounded(limit: int, most: int) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}, got {limit}")
    return limit


def _where_equal(df: DataFrame, conditions: Mapping[str, Any]) -> DataFrame:
    for name, value in conditions.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def get_summary(kpis: Kpis) -> DataFrame:
    """The newest summary row; no rows when none was computed."""
    return kpis["summary"].orderBy(F.desc("computed_at"), F.desc("id")).limit(1)


def get_revenue(kpis: Kpis, region: str | None = None, limit: int = 48) -> DataFrame:
    """The last hours, newest first, optionally of one region."""
    limit = _bounded(limit, 200)
    rows = _where_equal(kpis["hourly_revenue"], {"region": region} if region else {})
    return rows.orderBy(F.desc("hour_bucket"), "region").limit(limit)


def get_products(kpis: Kpis, category: str | None = None, limit: int = 10) -> DataFrame:
    """The leading products by revenue, optionally of one category.

    Every product is considered; ``rank`` is the place among those asked for.
    """
    limit = _bounded(limit, 50)
    rows = _where_equal(kpis["products"], {"category": category} if category else {})
    return rank_products(rows, limit)


def get_conversion(kpis: Kpis) -> DataFrame:
    """The funnel row; no rows when none was computed."""
    return kpis["conversion"].orderBy(F.desc("computed_at")).limit(1)


def get_inventory(kpis: Kpis, alerts_only: bool = True, limit: int = 50) -> DataFrame:
    """Stock per shelf, lowest first; only shelves with an alert unless told otherwise."""
    limit = _bounded(limit, 200)
    rows = _where_equal(kpis["inventory"], {"low_stock_alert": True} if alerts_only else {})
    stock = F.coalesce(F.col("current_stock"), F.lit(MISSING_STOCK))
    return rows.orderBy(stock, "product_id", "warehouse_id", "product_name").limit(limit)


def get_regions(kpis: Kpis) -> DataFrame:
    """All regions with revenue, sorted."""
    return distinct_values(kpis["hourly_revenue"], "region")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values of a text column, without NULL and ''."""
    values = df.select(column).filter(F.col(column).isNotNull() & (F.col(column) != ""))
    return values.distinct().orderBy(column)


def query_kpis(
    kpis: Kpis, kpi_type: str, where: Mapping[str, Any] | None = None, limit: int = 100
) -> DataFrame:
    """Rows of one KPI type that equal the given values, by id."""
    limit = _bounded(limit, MOST_ROWS)
    return _where_equal(kpis[kpi_type], where or {}).orderBy("id").limit(limit)


def get_item(kpis: Kpis, item_id: str, kpi_type: str) -> DataFrame:
    """The row with this id; no rows when there is none."""
    return _where_equal(kpis[kpi_type], {"id": item_id})


def envelope(page: DataFrame, **echo: Any) -> DataFrame:
    """A page of rows as one row: status, count, the echoed filters and the data.

    For the output of a read above, sorted and limited. A longer frame than any read
    returns is an error, found before its rows are gathered.
    """
    page = page.limit(MOST_ROWS + 1)
    # A limited page is one partition, so this id is the row's position.
    place = F.monotonically_increasing_id()
    longer = F.raise_error(F.lit(f"an envelope holds {MOST_ROWS} rows at most")).cast("bigint")
    placed = page.withColumn("_at", F.when(place >= MOST_ROWS, longer).otherwise(place))
    rows = F.array_sort(F.collect_list(F.struct("_at", F.struct(*page.columns).alias("row"))))
    filters: list[Column] = [F.lit(value).alias(name) for name, value in echo.items()]
    return placed.agg(F.count("*").alias("count"), rows.alias("rows")).select(
        F.lit("ok").alias("status"),
        "count",
        *filters,
        F.transform("rows", lambda r: r["row"]).alias("data"),
    )
