"""Sketches that are stored once and merged for any span: distinct customers, quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.kpis import completed
from tillstream.operators.request_log import QUANTILES, quantile_name, windowed

# A sketch of distinct values has 2**12 slots: three standard errors are under 5 %.
CUSTOMER_SLOTS = 12
CUSTOMER_ERROR = 0.05
# A quantile sketch of this size misses a rank by less than 2 % of the values, almost always.
LATENCY_SIZE = 400
RANK_ERROR = 0.02


def customer_sketches(orders: DataFrame, slots: int = CUSTOMER_SLOTS) -> DataFrame:
    """A sketch of the customers with completed orders, per hour and region.

    Null customers are in no sketch. Tasks sketch their rows before anything is shuffled.
    """
    hour = F.date_trunc("hour", F.col("event_ts")).alias("hour_bucket")
    sketch = F.hll_sketch_agg("customer_id", slots).alias("customers")
    return completed(orders).groupBy(hour, "region").agg(sketch)


def distinct_customers(
    sketches: DataFrame,
    by: Mapping[str, Column] | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Estimated distinct customers over any span (``until`` excluded) and set of regions.

    ``by`` names what to count for, e.g. ``{"day": F.to_date("hour_bucket")}``; a customer
    of several hours or regions counts once in each group.
    """
    if since is not None:
        sketches = sketches.filter(F.col("hour_bucket") >= F.lit(since))
    if until is not None:
        sketches = sketches.filter(F.col("hour_bucket") < F.lit(until))
    if regions is not None:
        sketches = sketches.filter(F.col("region").isin(*regions))
    groups = [column.alias(name) for name, column in (by or {}).items()]
    merged = F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers")
    return sketches.groupBy(*groups).agg(merged)


def latency_sketches(
    log: DataFrame, step: str = "1 minute", by: Sequence[str] = (), size: int = LATENCY_SIZE
) -> DataFrame:
    """A sketch of the measured durations per step and further columns."""
    measured = log.filter(F.col("duration_sec").isNotNull() & ~F.isnan("duration_sec"))
    sketch = F.kll_sketch_agg_double("duration_sec", size).alias("durations")
    return (
        measured.groupBy(F.window("ts", step).alias("window"), *by)
        .agg(sketch)
        .select(F.col("window.start").alias("step_start"), *by, "durations")
    )


def sketched_quantiles(
    sketches: DataFrame,
    qs: Sequence[float] = QUANTILES,
    window: str = "5 minutes",
    slide: str | None = None,
    by: Sequence[str] = (),
    size: int = LATENCY_SIZE,
) -> DataFrame:
    """Quantiles per window from the sketches of its steps; the log is not read again.

    A window must hold whole steps. ``requests`` is the number of measured requests.
    """
    windows = windowed("step_start", window, slide)
    merged = sketches.groupBy(windows, *by).agg(
        F.kll_merge_agg_double("durations", size).alias("durations")
    )
    values = [
        F.kll_sketch_get_quantile_double("durations", F.lit(float(q))).alias(quantile_name(q))
        for q in qs
    ]
    return merged.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        F.kll_sketch_get_n_double("durations").alias("requests"),
        *values,
    )
