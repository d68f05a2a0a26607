"""Increases and rates of counters that are scraped: resets, gaps and window edges.

A sample is (series columns, ``ts``, ``value``). A counter only grows, until its process
starts anew and it falls back to nought; a fall is such a reset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.operators.request_log import windowed

# Series are worked on in blocks of time, so a long one is not one task.
BLOCK = "6 hours"
# A gap to a window's edge beyond this many mean intervals is no late
# scrape, and the series is then taken to go on for half an interval only.
EDGE_INTERVALS, HALF = 1.1, 0.5


def with_growth(samples: DataFrame, series: Sequence[str], block: str = BLOCK) -> DataFrame:
    """Add ``growth``: how much the counter grew since the sample before, null for the first.

    After a reset it has grown by its new value. Within a block the sample before is
    looked up in order; the last sample of each block is carried to the next block that
    has any. Of samples in one moment the greatest counts. Rows without a time or value,
    or with NaN, are left out. Columns: series, ``ts``, ``value``, ``growth``.
    """
    kept = samples.filter(F.col("ts").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
    kept = kept.withColumn("_block", F.window("ts", block)["start"])
    # One exchange for all that follows within blocks.
    blocks = kept.repartition(*series, "_block").groupBy(*series, "_block", "ts").agg(
        F.max("value").alias("value")
    )
    inside = Window.partitionBy(*series, "_block").orderBy("ts")
    rows = blocks.withColumn("_before", F.lag("value").over(inside))
    rows = rows.withColumn("_first", F.row_number().over(inside) == 1)
    # One row per series and block.
    lasts = blocks.groupBy(*series, "_block").agg(
        F.max_by("value", F.unix_micros(F.col("ts").cast("timestamp"))).alias("_last")
    )
    along = Window.partitionBy(*series).orderBy("_block")
    carried = lasts.select(
        *[F.col(c).alias(f"_of_{c}") for c in series],
        F.col("_block").alias("_at"),
        F.lag("_last").over(along).alias("_carried"),
    )
    same = F.col("_block") == F.col("_at")
    for name in series:
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    rows = rows.join(carried, same)
    last = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    grown = F.when(F.col("value") >= last, F.col("value") - last).when(last.isNotNull(), F.col("value"))
    return rows.select(*series, "ts", "value", grown.alias("growth"))


def increase(
    samples: DataFrame,
    series: Sequence[str],
    window: str = "5 minutes",
    slide: str | None = None,
    block: str = BLOCK,
) -> DataFrame:
    """Growth of each series per window, carried on to the window's edges.

    The growth between the first and the last sample of a window is stretched to its edges:
    to an edge that is no further than a late scrape, else by half a mean interval, and
    back in time no further than to where the counter was nought. A window with less
    than two samples has no row. Columns: window, series, ``increase`` and ``per_second``.
    """
    grown = with_growth(samples, series, block)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    held = grown.groupBy(windowed("ts", window, slide), *series).agg(
        F.count("*").alias("_n"),
        F.min(at).alias("_from"),
        F.max(at).alias("_to"),
        F.min_by("value", at).alias("_value"),
        F.sum("growth").alias("_sum"),
        F.min_by(F.coalesce("growth", F.lit(0.0)), at).alias("_outside"),
    )
    held = held.filter("_n > 1")
    start, end = (F.unix_micros(F.col(f"window.{c}").cast("timestamp")) for c in ("start", "end"))
    first, last = F.col("_from"), F.col("_to")
    # The growth up to the first sample came before it.
    grown = F.col("_sum") - F.col("_outside")
    span = (last - first).cast("double")
    interval = span / (F.col("_n") - 1)

    def edge(gap: Column) -> Column:
        return F.when(gap >= interval * EDGE_INTERVALS, interval * HALF).otherwise(gap)

    # A counter that grew evenly was nought so long before its first sample.
    since_nought = span * F.col("_value") / grown
    back = edge((first - start).cast("double"))
    back = F.when((grown > 0) & (F.col("_value") >= 0), F.least(back, since_nought)).otherwise(back)
    ahead = edge((end - last).cast("double"))
    whole = F.when(span > 0, grown * (span + back + ahead) / span)
    seconds = (end - start) / 1_000_000
    return held.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *series,
        whole.alias("increase"),
        (whole / seconds).alias("per_second"),
    ).filter(F.col("increase").isNotNull())
