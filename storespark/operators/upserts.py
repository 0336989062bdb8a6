"""Insert-or-update and keyed deletes as rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storespark.operators.joins import POSITION_KEY, attach
from storespark.tables import Tables


def upsert(target: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Target rows with changed values replaced and new keys added."""
    values = [c for c in target.columns if c not in key]
    new = changes.select(*key, F.struct(*values).alias("_new"))
    old = target.select(*key, F.struct(*values).alias("_old"))
    row = F.coalesce("_new", "_old")
    return old.join(new, key, "full").withColumn("_row", row).select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in target.columns]
    )


def brands_upsert(brands: DataFrame, changes: DataFrame) -> DataFrame:
    return upsert(brands, changes, ["brand_code"])


# tables that lose their rows with a product, and tables that only forget a supplier
PRODUCT_CHILDREN = [
    "store_assortment", "inventory", "product_suppliers", "products_specifications", "cleaned_movements", "movements",
]
SUPPLIER_REFERENCES = ["cleaned_movements", "movements"]


def _without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return attach(df, gone, [key], "left_anti").select(*df.columns)


def _forgotten(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows with a deleted key set to null."""
    joined = attach(df, gone.withColumn("_gone", F.lit(True)), [key], "left")
    return joined.withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).select(*df.columns)


def cascade_delete(
    tables: Tables,
    products: DataFrame | None = None,
    suppliers: DataFrame | None = None,
    slots: DataFrame | None = None,
    raw_rows: DataFrame | None = None,
) -> Tables:
    """Tables after deleting the listed products, suppliers, layout slots and raw rows, with all that depends on them.

    A slot takes the assortment rows placed on it; a raw row takes its clean
    and bad row, and the fact forgets its number.
    """
    changed: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        return changed.get(name, tables[name])

    if products is not None:
        gone = products.select("product_id").distinct()
        for name in ["products", *PRODUCT_CHILDREN]:
            if name in tables:
                changed[name] = _without(table(name), gone, "product_id")
    if suppliers is not None:
        gone = suppliers.select("supplier_id").distinct()
        for name in ["suppliers", "product_suppliers"]:
            if name in tables:
                changed[name] = _without(table(name), gone, "supplier_id")
        for name in SUPPLIER_REFERENCES:
            if name in tables:
                changed[name] = _forgotten(table(name), gone, "supplier_id")
    if slots is not None:
        gone = slots.select(*POSITION_KEY).distinct()
        for name in ["store_layout", "store_assortment"]:
            if name in tables:
                frame = table(name)
                changed[name] = attach(frame, gone, POSITION_KEY, "left_anti").select(*frame.columns)
    if raw_rows is not None:
        gone = raw_rows.select("raw_movement_id").distinct()
        for name in ["raw_movements", "cleaned_movements", "bad_movements"]:
            if name in tables:
                changed[name] = _without(table(name), gone, "raw_movement_id")
        if "movements" in tables and "raw_movement_id" in tables["movements"].columns:
            changed["movements"] = _forgotten(table("movements"), gone, "raw_movement_id")
    return tables.replaced(**changed)
