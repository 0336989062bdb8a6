"""The six validation rules of raw movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.functions import fixed_values as fixed
from storespark.operators.joins import attach

CLEANED_COLUMNS = [
    "raw_movement_id", "source_file_name", "source_system", "store_id", "product_id", "supplier_id",
    "movement_type", "quantity", "unit_sale_price", "unit_purchase_price", "is_promo", "promo_type",
    "movement_timestamp", "movement_date",
]
BAD_COLUMNS = CLEANED_COLUMNS + ["error_reason", "error_details"]
FACT_COLUMNS = (
    CLEANED_COLUMNS[:6] + ["shelf_id", "shelf_level", "zone", "slot_number"] + CLEANED_COLUMNS[6:]
)

_PRODUCT_FLAG, _SUPPLIER_FLAG = "_known_product", "_known_supplier"


def _holds(condition: Column) -> Column:
    """A comparison with null does not hold."""
    return F.coalesce(condition, F.lit(False))


def _no_price(kind: str, price: str) -> Column:
    return _holds(F.col("movement_type") == kind) & (F.col(price).isNull() | _holds(F.col(price) <= 0))


def rule_conditions() -> dict[str, Column]:
    """Rules in order, over a frame that went through ``with_known_keys``."""
    kind, supplier = F.col("movement_type"), F.col("supplier_id")
    priced = F.col("unit_sale_price").isNotNull() | F.col("unit_purchase_price").isNotNull()
    return {
        "unknown_product": F.col(_PRODUCT_FLAG).isNull(),
        "unknown_supplier": supplier.isNotNull() & F.col(_SUPPLIER_FLAG).isNull(),
        "missing_sale_price": _no_price("sale", "unit_sale_price"),
        "missing_purchase_price": _no_price("purchase", "unit_purchase_price"),
        "breakage_with_price": _holds(kind == "breakage") & priced,
        "purchase_without_supplier": _holds(kind == "purchase") & supplier.isNull(),
    }


def valid_keys(table: DataFrame, key: str, flag: str) -> DataFrame:
    return table.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))


def with_known_keys(raw: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Mark rows whose product and supplier exist."""
    marked = attach(raw, valid_keys(products, "product_id", _PRODUCT_FLAG), ["product_id"], "left")
    return attach(marked, valid_keys(suppliers, "supplier_id", _SUPPLIER_FLAG), ["supplier_id"], "left")


def rule_breakers(raw: DataFrame, products: DataFrame, suppliers: DataFrame, rule: str) -> DataFrame:
    """All rows one rule catches, whatever the other rules say."""
    marked = with_known_keys(raw, products, suppliers)
    return marked.filter(rule_conditions()[rule]).select(*raw.columns)


def validate(raw: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Raw rows with ``error_reason`` and ``error_details`` of the first rule they break, null if none."""
    marked = with_known_keys(raw, products, suppliers)
    reason = details = None
    for rule, condition in rule_conditions().items():
        reason = (F if reason is None else reason).when(condition, rule)
    marked = marked.withColumn("error_reason", reason)
    for rule, text in fixed.RULE_TEXTS.items():
        details = (F if details is None else details).when(F.col("error_reason") == rule, text)
    return marked.withColumn("error_details", details).select(*raw.columns, "error_reason", "error_details")


def clean_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("error_reason").isNull()).drop("error_reason", "error_details")


def bad_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("error_reason").isNotNull())


def cleaned_projection(clean: DataFrame) -> DataFrame:
    return clean.select(*CLEANED_COLUMNS)


def bad_projection(bad: DataFrame) -> DataFrame:
    return bad.select(*BAD_COLUMNS, F.lit(False).alias("reviewed"), F.lit(False).alias("corrected"))


def movements_projection(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def validation_counts(validated: DataFrame, by: str = "source_file_name") -> DataFrame:
    return validated.groupBy(by).agg(
        F.count("*").alias("rows_processed"),
        F.count_if(F.col("error_reason").isNull()).alias("rows_success"),
        F.count_if(F.col("error_reason").isNotNull()).alias("rows_failed"),
    )
