"""Rollups of a request log (ts, method, endpoint, status, duration_sec).

Each works on a table, and on a stream when ``late`` gives the watermark delay.
All of them are plain grouped sums, so tasks reduce their rows to one per group
before anything is shuffled. Overlapping windows of a table are counted by slide step
first; only the counts of the steps are copied into each window they are part of.

Counts are exact counts of log rows. A dashboard that derives them from scraped
counters extrapolates between scrapes; that is not reproduced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the latency buckets, in seconds; +Inf follows.
LATENCY_BUCKETS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
QUANTILES = (0.5, 0.95, 0.99)
# Where the dashboard changes colour.
ERROR_RATE_STEPS = ((0, "green"), (1, "yellow"), (5, "red"))
STORE_ERROR_STEPS = ((0, "green"), (1, "red"))


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(length: str) -> int | None:
    """``5 minutes`` in seconds; None for anything but a whole number of one unit."""
    number, _, unit = length.strip().partition(" ")
    size = _SECONDS.get(unit.strip().lower().removesuffix("s"))
    return int(number) * size if size and number.isdigit() else None


def windowed(column: str, window: str, slide: str | None = None) -> Column:
    """The window, or overlapping windows, a moment is in."""
    return F.window(column, window, slide or window).alias("window")


def quantile_name(q: float) -> str:
    return f"p{100 * q:g}".replace(".", "_")


def _per_window(
    log: DataFrame,
    window: str,
    by: Sequence[str],
    slide: str | None,
    late: str | None,
    counts: Mapping[str, Column],
) -> DataFrame:
    """``counts`` (each a count of rows) per window and further columns."""
    measures = [count.alias(name) for name, count in counts.items()]
    whole, step = _seconds(window), _seconds(slide or window)
    stepwise = whole and step and whole > step and whole % step == 0
    if late is not None:
        log = log.withWatermark("ts", late)
    if log.isStreaming or not stepwise:
        windows = F.window("ts", window, slide or window).alias("window")
        return log.groupBy(windows, *by).agg(*measures)
    steps = log.groupBy(F.window("ts", slide).alias("_step"), *by).agg(*measures)
    steps = steps.select(F.col("_step.start").alias("_at"), *by, *counts)
    windows = F.window("_at", window, slide).alias("window")
    return steps.groupBy(windows, *by).agg(*[F.sum(name).alias(name) for name in counts])


def _flat(rollup: DataFrame) -> DataFrame:
    rest = [c for c in rollup.columns if c != "window"]
    return rollup.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def request_counts(
    log: DataFrame,
    window: str = "5 minutes",
    by: Sequence[str] = (),
    slide: str | None = None,
    late: str | None = None,
) -> DataFrame:
    """Requests per window and, if given, per further columns."""
    return _flat(_per_window(log, window, by, slide, late, {"requests": F.count("*")}))


def error_rate(
    log: DataFrame, window: str = "5 minutes", slide: str | None = None, late: str | None = None
) -> DataFrame:
    """Share of 5xx responses per window, in percent."""
    counts = {"failed": F.count_if(F.col("status").between(500, 599)), "requests": F.count("*")}
    counted = _per_window(log, window, (), slide, late, counts)
    rate = F.col("failed") / F.col("requests") * 100
    return _flat(counted.select("window", rate.alias("error_pct")))


def request_rate(
    log: DataFrame, window: str = "1 minute", slide: str | None = None, late: str | None = None
) -> DataFrame:
    """Requests per second, by endpoint."""
    counts = request_counts(log, window, ("endpoint",), slide, late)

    def instant(name: str) -> Column:
        return F.unix_seconds(F.col(name).cast("timestamp"))

    seconds = instant("window_end") - instant("window_start")
    return counts.select(
        "window_start", "window_end", "endpoint", (F.col("requests") / seconds).alias("per_second")
    )


def status_breakdown(
    log: DataFrame, window: str = "30 minutes", slide: str | None = None, late: str | None = None
) -> DataFrame:
    """Requests per status code."""
    return request_counts(log, window, ("status",), slide, late)


def store_errors(
    log: DataFrame, window: str = "5 minutes", slide: str | None = None, late: str | None = None
) -> DataFrame:
    """Failed KPI-store calls per window; their log rows name the ``operation``."""
    return request_counts(log.filter(F.col("operation").isNotNull()), window, (), slide, late)


def classify(
    df: DataFrame, column: str, steps: Sequence[tuple[float, str]], into: str = "band"
) -> DataFrame:
    """Label a value with the last step it reaches; below the first step, the first label."""
    value = F.col(column)
    label = F.lit(steps[0][1])
    for start, name in steps[1:]:
        label = F.when(value >= start, F.lit(name)).otherwise(label)
    return df.withColumn(into, F.when(value.isNotNull(), label))


def _bucket_counts(buckets: Sequence[float]) -> dict[str, Column]:
    """Rows at or under each bound, then all measured rows (the +Inf bucket)."""
    duration = F.col("duration_sec")
    under = [F.count_if(duration <= F.lit(float(le))) for le in buckets]
    return {f"_le{i}": n for i, n in enumerate([*under, F.count(duration)])}


def latency_histogram(
    log: DataFrame,
    buckets: Sequence[float] = LATENCY_BUCKETS,
    window: str = "1 minute",
    slide: str | None = None,
    late: str | None = None,
) -> DataFrame:
    """Cumulative latency buckets, one row per window and bound ``le``."""
    bounds = [*map(float, buckets), float("inf")]
    counts = _bucket_counts(buckets)
    wide = _per_window(log, window, (), slide, late, counts)
    rows = [
        F.struct(F.lit(le).alias("le"), F.col(name).alias("requests"))
        for le, name in zip(bounds, counts)
    ]
    return _flat(wide.select("window", F.inline(F.array(*rows))))


def _quantile_from(counts: Sequence[str], buckets: Sequence[float], q: float) -> Column:
    """Linear interpolation inside the bucket that holds the q-th request.

    The first bucket starts at 0; the open last bucket gives the highest finite bound.
    """
    wanted = F.col(counts[-1]) * F.lit(q)
    value = F.lit(float(buckets[-1]))
    edges = [0.0, *map(float, buckets)]
    for i in reversed(range(len(buckets))):
        low, high, n = edges[i], edges[i + 1], F.col(counts[i])
        before = F.col(counts[i - 1]) if i else F.lit(0)
        # An empty bucket can only be reached by wanted = 0, at its lower edge.
        share = F.when(n > before, (wanted - before) / (n - before)).otherwise(F.lit(0.0))
        value = F.when(n >= wanted, F.lit(low) + F.lit(high - low) * share).otherwise(value)
    return F.when(F.col(counts[-1]) > 0, value)


def latency_quantiles(
    log: DataFrame,
    qs: Sequence[float] = QUANTILES,
    window: str = "5 minutes",
    buckets: Sequence[float] = LATENCY_BUCKETS,
    slide: str | None = None,
    late: str | None = None,
) -> DataFrame:
    """Latency quantiles per window, estimated from the cumulative buckets.

    A window keeps one count per bucket, however many requests it has.
    """
    counts = _bucket_counts(buckets)
    names = list(counts)
    counted = _per_window(log, window, (), slide, late, counts)
    labelled: Mapping[str, Column] = {
        quantile_name(q): _quantile_from(names, buckets, q) for q in qs
    }
    return _flat(counted.select("window", *[c.alias(name) for name, c in labelled.items()]))
