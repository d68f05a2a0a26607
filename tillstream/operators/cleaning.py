"""Bronze -> silver: validate, keep the latest copy, standardise, enrich.

Duplicates go first and columns are derived after, so the one shuffle here
carries bronze columns only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstream.functions.text import standard_text
from tillstream.functions.times import event_time, processing_time
from tillstream.operators.dedup import RECORD_ORDER, dedup_latest
from tillstream.operators.validation import split_valid
from tillstream.schemas import CLICKS, INVENTORY, ORDERS, EventSpec

# Fixed value: the order total from which an order counts as high.
HIGH_VALUE_FROM = 200.0


def standardise(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Trim the named columns and set their case."""
    return df.withColumns({c: standard_text(c, rule) for c, rule in rules.items()})


def stamp(df: DataFrame, name: str, at: datetime | None = None) -> DataFrame:
    """Add the time the row was processed (a fixed time when ``at`` is given)."""
    return df.withColumn(name, processing_time(at))


def enrich_orders(df: DataFrame, high_value: float = HIGH_VALUE_FROM) -> DataFrame:
    return df.withColumns(
        {
            "is_high_value": F.col("total_amount") >= F.lit(high_value),
            "is_discounted": F.col("discount_pct") > 0,
        }
    )


def absolute_page_time(df: DataFrame) -> DataFrame:
    """Clock skew gives negative durations: keep the magnitude."""
    seconds = F.abs(F.col("time_on_page_sec").cast("bigint"))
    return df.withColumn("time_on_page_sec", seconds.try_cast("int"))


def _clean(
    bronze: DataFrame,
    spec: EventSpec,
    strict: bool,
    detail: bool,
    order: Sequence[str],
    seen: Observation | None,
) -> tuple[DataFrame, DataFrame]:
    valid, rejected = split_valid(bronze, spec, strict, detail)
    if seen is not None:
        # Above the filter, so the rules still reach the file scan.
        valid = valid.observe(seen, F.count(F.lit(1)).alias("valid_rows"))
    silver = standardise(dedup_latest(valid.drop("_raw"), order=order), spec.text_rules)
    return silver.withColumn("event_ts", event_time("timestamp")), rejected


def clean_orders(
    bronze: DataFrame,
    strict: bool = False,
    detail: bool = False,
    high_value: float = HIGH_VALUE_FROM,
    order: Sequence[str] = RECORD_ORDER,
    seen: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Silver orders and the quarantined rest."""
    silver, rejected = _clean(bronze, ORDERS, strict, detail, order, seen)
    return stamp(enrich_orders(silver, high_value), "silver_processed_at"), rejected


def clean_clicks(
    bronze: DataFrame,
    strict: bool = False,
    detail: bool = False,
    order: Sequence[str] = RECORD_ORDER,
    seen: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Silver clicks and the quarantined rest."""
    silver, rejected = _clean(bronze, CLICKS, strict, detail, order, seen)
    return stamp(absolute_page_time(silver), "silver_processed_at"), rejected


def clean_inventory(
    bronze: DataFrame,
    strict: bool = False,
    detail: bool = False,
    order: Sequence[str] = RECORD_ORDER,
    seen: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Silver inventory updates and the quarantined rest."""
    silver, rejected = _clean(bronze, INVENTORY, strict, detail, order, seen)
    return stamp(silver, "silver_processed_at"), rejected


CLEANERS = {"orders": clean_orders, "clicks": clean_clicks, "inventory": clean_inventory}
