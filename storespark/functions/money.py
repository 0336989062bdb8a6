"""Exact decimal arithmetic.

Sums of quantity x price are kept as decimal(38,4). Spark cuts the scale of a
quotient of two wide decimals to six digits, which would round twice, so
quotients are made from whole parts and exact remainders.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,4)"


def line_value(price: Column, quantity: Column | None = None) -> Column:
    """quantity x price, exact. Summed quantities stay within 18 digits, which Spark holds in a long."""
    return (F.col("quantity") if quantity is None else quantity.cast("decimal(18,0)")) * price


def money_sum(value: Column) -> Column:
    return F.sum(value).cast(MONEY)


def money_sum0(value: Column) -> Column:
    return F.coalesce(money_sum(value), F.lit(0).cast(MONEY))


def margin_pct(revenue: Column, cost: Column) -> Column:
    """Margin as percent of revenue, two digits half-up; 0 for no revenue, null for unknown revenue or cost."""
    rev, cst = revenue.cast(MONEY), cost.cast(MONEY)
    zero = F.lit(0).cast("decimal(38,2)")
    return F.when(rev == 0, zero).otherwise(ratio((rev - cst).cast(MONEY) * 100, rev, 2))


def ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """numerator / denominator rounded half-up, once; null when the denominator is 0.

    The quotient is put together from its whole part and the remainder's
    digits. Remainders are exact, and each division leaves none, so no step
    rounds but the last.
    """
    num, den = numerator.cast(MONEY), denominator.cast(MONEY)
    size, by = F.abs(num), F.abs(F.when(den != 0, den))
    rest = (size % by).cast(MONEY)
    whole = ((size - rest).cast(MONEY) / by).cast("decimal(38,0)")
    shifted = (rest * F.lit(10**digits)).cast(MONEY)
    left = (shifted % by).cast(MONEY)
    fraction = ((shifted - left).cast(MONEY) / by).cast("decimal(18,0)")
    up = F.when((left * 2).cast(MONEY) >= by, 1).otherwise(0).cast("decimal(18,0)")
    ulp = F.lit(Decimal(1).scaleb(-digits)).cast(f"decimal(18,{digits})")
    quotient = whole.cast(f"decimal(38,{digits})") + ((fraction + up).cast("decimal(18,0)") * ulp)
    negative = (num < 0) != (den < 0)
    return F.when(negative, -quotient).otherwise(quotient).cast(f"decimal(38,{digits})")


def percent(part: Column, whole: Column) -> Column:
    """100 x part / whole with two digits; null when the whole is 0."""
    return ratio(part.cast(MONEY) * 100, whole, 2)


def fill_pct(stock: Column, capacity: Column) -> Column:
    """Stock as percent of capacity, one digit; 0 for capacity 0, null for unknown capacity."""
    cap = capacity.cast("decimal(10,0)")
    share = stock.cast("decimal(10,0)").cast("decimal(18,0)") * 100 / F.when(cap != 0, cap)
    return F.when(cap == 0, F.lit(0).cast("decimal(18,1)")).otherwise(F.round(share, 1).cast("decimal(18,1)"))


def half_even_cents(price: Column) -> Column:
    return F.bround(price, 2)
