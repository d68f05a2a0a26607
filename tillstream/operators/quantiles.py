"""Exact quantiles by distributed selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.operators.request_log import QUANTILES, quantile_name, windowed

# Each pass cuts the range that holds a wanted value into so many parts.
PASSES, PARTS = 3, 1024


def _part(parts: int) -> Column:
    """Which part of its range a value is in; ranges that cannot be cut are one part."""
    share = (F.col("_value") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    whole = (F.col("_high") > F.col("_low")) & ~F.isnan(share)
    return F.when(whole, F.least(F.floor(share * parts), F.lit(parts - 1))).otherwise(F.lit(0))


def _held(values: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values in each range that a target is in."""
    ranges = targets.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_low", "_high").distinct()
    same = (F.col("_value") >= F.col("_low")) & (F.col("_value") <= F.col("_high"))
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return values.join(ranges, same).drop(*[f"_of_{k}" for k in keys])


def _narrowed(values: DataFrame, targets: DataFrame, keys: Sequence[str], part: Column) -> DataFrame:
    """The targets with the range of the part that holds their rank."""
    parts = (
        _held(values, targets, keys)
        .groupBy(*keys, "_low", "_high", part.alias("_part"))
        .agg(F.sum("_n").alias("_n"), F.min("_value").alias("_from"), F.max("_value").alias("_to"))
    )
    # As many rows as a range has parts.
    so_far = Window.partitionBy(*keys, "_low", "_high").orderBy("_part")
    parts = parts.withColumn("_before", F.sum("_n").over(so_far) - F.col("_n"))
    left, right = targets.alias("t"), parts.alias("p")
    place = F.col("t._rank") - F.col("t._below")
    same = (place >= F.col("p._before")) & (place < F.col("p._before") + F.col("p._n"))
    for key in (*keys, "_low", "_high"):
        same = same & F.col(f"t.{key}").eqNullSafe(F.col(f"p.{key}"))
    return left.join(right, same).select(
        *[F.col(f"t.{k}").alias(k) for k in keys],
        "t._rank",
        (F.col("t._below") + F.col("p._before")).alias("_below"),
        F.col("p._from").alias("_low"),
        F.col("p._to").alias("_high"),
    )


def select_ranks(
    values: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    passes: int = PASSES,
    parts: int = PARTS,
) -> DataFrame:
    """The value at each wanted ``_rank`` (from 0) of its group.

    ``values``: keys, ``_value`` and how often it occurs, ``_n``. ``targets``: keys, ``_rank``,
    and a range ``_low``, ``_high`` that holds the group. Every pass counts the values of
    each range by part, and keeps the part with the wanted rank and its own least and
    greatest value. The values of the parts that are left are then put in order; they are
    few unless values lie closer than a range cut ``passes`` times.
    """
    targets = targets.withColumn("_below", F.lit(0).cast("bigint"))
    for _ in range(passes):
        targets = _narrowed(values, targets, keys, _part(parts))
    # Every value a part of its own.
    found = _narrowed(values, targets, keys, F.col("_value"))
    return found.select(*keys, "_rank", F.col("_low").alias("_value"))


def exact_quantiles(
    log: DataFrame,
    qs: Sequence[float] = QUANTILES,
    window: str = "5 minutes",
    slide: str | None = None,
    by: Sequence[str] = (),
    column: str = "duration_sec",
    passes: int = PASSES,
    parts: int = PARTS,
) -> DataFrame:
    """Exact quantiles per window (and further columns), between values where they fall there.

    Equal values of a window are counted in tasks first; a window's values are never in one
    task, whatever its share of all rows. Null and NaN are no values; a window without any has
    no row.
    """
    measured = log.filter(F.col(column).isNotNull() & ~F.isnan(column))
    values = measured.groupBy(windowed("ts", window, slide), *by, F.col(column).alias("_value")).agg(
        F.count("*").alias("_n")
    )
    values = values.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        "_value",
        "_n",
    )
    keys = ["window_start", "window_end", *by]
    groups = values.groupBy(*keys).agg(
        F.sum("_n").alias("_all"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    places = F.array(
        *[
            F.struct(F.lit(k).alias("_q"), ((F.col("_all") - 1) * F.lit(float(q))).alias("_at"))
            for k, q in enumerate(qs)
        ]
    )
    wanted = groups.select(*keys, "_low", "_high", F.inline(places))
    ends = F.array(F.floor("_at"), F.ceil("_at"))
    targets = wanted.select(*keys, "_low", "_high", F.explode(ends).alias("_rank")).distinct()
    found = select_ranks(values, targets, keys, passes, parts)

    def at(side: str) -> DataFrame:
        return found.select(
            *[F.col(k).alias(f"_{side}_{k}") for k in keys],
            F.col("_rank").alias(f"_{side}_rank"),
            F.col("_value").alias(f"_{side}"),
        )

    rows = wanted.select(*keys, "_q", "_at")
    for side, rank in (("lower", F.floor("_at")), ("upper", F.ceil("_at"))):
        other = at(side)
        same = rank == F.col(f"_{side}_rank")
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_{side}_{key}"))
        rows = rows.join(other, same).select(*rows.columns, f"_{side}")
    share = F.col("_at") - F.floor("_at")
    value = F.when(F.col("_lower") == F.col("_upper"), F.col("_lower")).otherwise(
        F.col("_lower") + (F.col("_upper") - F.col("_lower")) * share
    )
    named = [
        F.max(F.when(F.col("_q") == k, value)).alias(quantile_name(q)) for k, q in enumerate(qs)
    ]
    return rows.groupBy(*keys).agg(*named)
