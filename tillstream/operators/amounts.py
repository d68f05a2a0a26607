"""Amounts an order must carry and the alert a stock level implies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import money

# Fixed value: the threshold of a stock update that names none.
LOW_STOCK_BELOW = 50
# Leaves room for the product with a quantity at full precision.
PRICE_TYPE = "decimal(24,8)"


def _subtotal() -> Column:
    """Price by quantity at full precision, rounded once."""
    return F.round(F.col("product.unit_price").try_cast(PRICE_TYPE) * F.col("quantity"), 2)


def _discount(subtotal: Column) -> Column:
    return F.round(
        subtotal.cast("decimal(28,2)") * F.col("discount_pct").try_cast("decimal(9,4)"), 2
    )


def derive_order_amounts(orders: DataFrame) -> DataFrame:
    """Set subtotal, discount and total from price, quantity and discount rate."""
    priced = orders.withColumn("subtotal", _subtotal())
    priced = priced.withColumn("discount_amount", _discount(F.col("subtotal")))
    priced = priced.withColumn("total_amount", F.col("subtotal") - F.col("discount_amount"))
    amounts = ("subtotal", "discount_amount", "total_amount")
    return priced.withColumns({c: F.round(c, 2).cast("double") for c in amounts})


def check_amounts(orders: DataFrame) -> DataFrame:
    """Orders whose stored amounts do not follow from each other, one flag per amount.

    Each amount is checked against the stored ones it is made from. A missing
    amount counts as wrong.
    """
    subtotal, discount = money("subtotal"), money("discount_amount")

    def matches(stored: Column, expected: Column) -> Column:
        return F.coalesce(stored == expected, F.lit(False))

    flags = {
        "subtotal_ok": matches(subtotal, _subtotal()),
        "discount_ok": matches(discount, _discount(subtotal)),
        "total_ok": matches(money("total_amount"), subtotal - discount),
    }
    wrong = ~(F.col("subtotal_ok") & F.col("discount_ok") & F.col("total_ok"))
    return orders.withColumns(flags).filter(wrong)


def _low(below: int) -> Column:
    threshold = F.coalesce(F.col("reorder_threshold"), F.lit(below))
    return F.col("stock_level") < threshold


def derive_low_stock(inventory: DataFrame, below: int = LOW_STOCK_BELOW) -> DataFrame:
    """Set the alert: stock under the update's own threshold, or ``below`` without one."""
    return inventory.withColumn("low_stock_alert", _low(below))


def check_low_stock(inventory: DataFrame, below: int = LOW_STOCK_BELOW) -> DataFrame:
    """Stock updates whose alert is not the one their level and threshold imply."""
    return inventory.filter(~F.col("low_stock_alert").eqNullSafe(_low(below)))
