"""Counts and sums of movements by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.functions.money import line_value, money_sum, money_sum0


def of_kind(kind: str, value: Column) -> Column:
    """``value`` of movements of one kind, null of others."""
    return F.when(F.col("movement_type") == kind, value)


def count_of(kind: str) -> Column:
    return F.count_if(F.col("movement_type") == kind)


def quantity_of(kind: str) -> Column:
    """Pieces moved by one kind; 0 where there is none."""
    return F.coalesce(F.sum(of_kind(kind, F.col("quantity"))), F.lit(0))


def movement_counts(movements: DataFrame, *by: str) -> DataFrame:
    """How many sales, breakages and purchases each group holds."""
    return movements.groupBy(*by).agg(
        count_of("sale").alias("sales"), count_of("breakage").alias("breakages"), count_of("purchase").alias("purchases")
    )


def movement_sums(movements: DataFrame, *by: str) -> DataFrame:
    """Pieces sold and the cost of what was bought per group; sums of nothing are 0."""
    cost = money_sum0(of_kind("purchase", line_value(F.col("unit_purchase_price"))))
    return movements.groupBy(*by).agg(quantity_of("sale").alias("qty_sold"), cost.alias("purchase_cost"))


def revenue(movements: DataFrame, *by: str) -> DataFrame:
    """Quantity times sale price per group; null where no movement has a price."""
    return movements.groupBy(*by).agg(money_sum(line_value(F.col("unit_sale_price"))).alias("revenue"))
