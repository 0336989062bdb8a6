"""Purchase proposals for products below their minimum stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storespark.tables import Tables


def replenishment_candidates(t: Tables, primary_factor: str = "1.25", secondary_factor: str = "0.75") -> DataFrame:
    """One row per supplier option of a product below its minimum, ``option_rank`` 1 being the first choice.

    The quantity is the reorder lot times a factor by kind of supplier, at least
    1 and at least enough to lift a negative stock above zero. Products without
    a supplier or an inventory row get no proposal.
    """
    factor = F.when(F.col("is_primary_supplier"), F.lit(primary_factor).cast("decimal(5,2)")).otherwise(
        F.lit(secondary_factor).cast("decimal(5,2)")
    )
    lot = F.floor(F.col("reorder_lot") * factor).cast("int")
    deficit = F.when(F.col("stock_qty") < 0, -F.col("stock_qty") + 1)
    specs = t.products_specifications.select("product_id", "minimum_stock_threshold", "reorder_lot")
    stores = t.inventory.select("store_id", "product_id", "stock_qty")
    low = stores.join(specs, "product_id").filter(F.col("stock_qty") < F.col("minimum_stock_threshold"))
    options = low.join(t.product_suppliers.select("product_id", "supplier_id", "is_primary_supplier"), "product_id")
    # a product has as many rows here as it has suppliers
    choice = W.partitionBy("store_id", "product_id").orderBy(F.desc("is_primary_supplier"), "supplier_id")
    return options.select(
        "store_id", "product_id", "stock_qty", "minimum_stock_threshold", "supplier_id", "is_primary_supplier",
        F.greatest(F.lit(1), lot, deficit).alias("suggested_qty"),
        F.row_number().over(choice).alias("option_rank"),
    )
