"""Money and rates: decimal sums, half-up rounding at two places.

Double sums depend on the order in which partitions are merged, so amounts are
added up as decimals, at eight places, and rounded once, after the sum. A value that
has no decimal form (NaN, infinite, 1e20 and more) becomes NULL and stays out of sum
and mean; the silver job counts such amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(28,8)"


def money(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast(MONEY_TYPE)


def no_decimal_form(column: str) -> Column:
    """Whether an amount is there but cannot be added up."""
    return F.col(column).isNotNull() & money(column).isNull()


def money_sum(column: str) -> Column:
    return F.round(F.sum(money(column)), 2).cast("double")


def money_mean(column: str) -> Column:
    """Over the amounts that have a decimal form, as the sum is."""
    return F.round(F.sum(money(column)) / F.count(money(column)), 2).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole at two places, 0.0 where there is no whole."""
    exact = part.cast("decimal(20,0)") * 100 / whole
    return F.when(whole > 0, F.round(exact, 2).cast("double")).otherwise(F.lit(0.0))
