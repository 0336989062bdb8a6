"""Stock per store and product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STOCK_KEY = ["store_id", "product_id"]


def signed_quantity() -> Column:
    """Purchases add stock, every other movement takes it."""
    quantity = F.col("quantity").cast("bigint")
    return F.when(F.col("movement_type") == "purchase", quantity).otherwise(-quantity)


def net_stock_delta(movements: DataFrame) -> DataFrame:
    """Net change per store and product. Partial sums leave at most one row per key and task."""
    return movements.groupBy(*STOCK_KEY).agg(F.sum(signed_quantity()).alias("net_qty"))


def touch_updated_at(inventory: DataFrame, touched: Column, now: Column | None = None) -> DataFrame:
    """Renew ``updated_at`` of the rows ``touched`` marks."""
    now = F.current_timestamp() if now is None else now
    return inventory.withColumn("updated_at", F.when(touched, now).otherwise(F.col("updated_at")))


def inventory_apply(inventory: DataFrame, delta: DataFrame, now: Column | None = None) -> DataFrame:
    """Inventory after a net change; changes of keys without inventory are ignored, a zero change still touches."""
    joined = inventory.join(delta, STOCK_KEY, "left")
    stock = (F.col("stock_qty") + F.coalesce(F.col("net_qty"), F.lit(0))).cast("int")
    moved = joined.withColumn("stock_qty", stock)
    return touch_updated_at(moved, F.col("net_qty").isNotNull(), now).select(*inventory.columns)


def opening_stock(specifications: DataFrame, stores: list[int] | None = None) -> DataFrame:
    """First stock of every store: the initial stock of products in assortment, 0 for the others."""
    stock = F.when(F.col("assortment_flag"), F.col("initial_stock")).otherwise(0)
    each_store = F.explode(F.array(*[F.lit(s).cast("int") for s in stores or [1]]))
    return specifications.select(
        each_store.alias("store_id"), "product_id", stock.cast("int").alias("stock_qty")
    )


def mark_loaded(cleaned: DataFrame, loaded_ids: DataFrame, now: Column | None = None) -> DataFrame:
    """Set ``loaded`` and ``loaded_at`` of the rows whose id is listed."""
    now = F.current_timestamp() if now is None else now
    ids = loaded_ids.select("cleaned_movement_id").distinct().withColumn("_hit", F.lit(True))
    joined = cleaned.join(ids, "cleaned_movement_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.withColumns(
        {"loaded": hit | F.col("loaded"), "loaded_at": F.when(hit, now).otherwise(F.col("loaded_at"))}
    ).select(*cleaned.columns)


def unloaded_movements(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(~F.col("loaded"))


def clamp_threshold(initial: Column, minimum: Column, in_assortment: Column) -> Column:
    """A minimum at or above the initial stock becomes a third of it, at least 1; 0 outside the assortment."""
    third = F.greatest(F.lit(1), F.floor(initial / 3).cast("int"))
    return F.when(~F.coalesce(in_assortment, F.lit(False)), F.lit(0)).otherwise(
        F.when(minimum >= initial, third).otherwise(minimum)
    )
