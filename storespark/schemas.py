"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_SIMPLE = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "date": T.DateType(),
}


def _type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _SIMPLE[name]


def _schema(columns: str) -> T.StructType:
    """Schema of ``name type`` pairs, without the session that ``fromDDL`` asks for."""
    pairs = [c.split(" ") for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _type(kind)) for name, kind in pairs])


MOVEMENT_COLUMNS = [
    "store_id", "product_id", "supplier_id", "movement_type", "quantity",
    "unit_sale_price", "unit_purchase_price", "is_promo", "promo_type",
    "movement_timestamp", "movement_date",
]

MOVEMENT_TYPES = {
    "store_id": "int",
    "product_id": "string",
    "supplier_id": "string",
    "movement_type": "string",
    "quantity": "int",
    "unit_sale_price": "decimal(12,4)",
    "unit_purchase_price": "decimal(12,4)",
    "is_promo": "boolean",
    "promo_type": "string",
    "movement_timestamp": "timestamp",
    "movement_date": "date",
}

# columns a raw row must carry
REQUIRED = [
    "store_id", "product_id", "movement_type", "quantity", "is_promo",
    "movement_timestamp", "movement_date",
]

_MOVEMENT_DDL = ", ".join(f"{c} {t}" for c, t in MOVEMENT_TYPES.items())
_SOURCE_DDL = "raw_movement_id bigint, source_file_name string, source_system string"
POSITION_COLUMNS = ["shelf_id", "shelf_level", "zone", "slot_number"]
_POSITION_DDL = "shelf_id int, shelf_level int, zone string, slot_number int"

# a movement file is read as text and typed afterwards; a line with a wrong number of cells is kept whole
MALFORMED = "_corrupt_record"
MOVEMENT_CSV = T.StructType([T.StructField(c, T.StringType()) for c in [*MOVEMENT_COLUMNS, MALFORMED]])

PRICE_LIST_COLUMNS = {
    "ProductId": "id_prodotto",
    "Description": "descrizione",
    "Lev1Description": "cat1",
    "Lev2Description": "cat2",
    "Lev3Description": "cat3",
    "VatCode": "iva",
    "PcsCar": "pzxcar",
    "SaleUnitId": "um",
    "Brand": "brand",
    "CurrentSalePrice": "costo",
    "CurrentSellingPrice": "prezzo_vendita",
}

PRODUCT_MASTER_COLUMNS = {
    "id_prodotto": "product_id",
    "descrizione": "product_description",
    "cat1": "category_level_1",
    "cat2": "category_level_2",
    "cat3": "category_level_3",
    "iva": "vat_rate",
    "um": "unit_of_measure",
    "costo": "purchase_price",
    "prezzo_vendita": "sale_price",
    "brand": "brand_code",
}

TABLES: dict[str, T.StructType] = {
    "products": _schema(
        "product_id string, product_description string, category_level_1 string, category_level_2 string, "
        "category_level_3 string, vat_rate decimal(5,2), unit_of_measure string, purchase_price decimal(12,4), "
        "sale_price decimal(12,4), brand_code string"
    ),
    "brands": _schema("brand_code string, brand_name string"),
    "store_layout": _schema(f"store_id int, {_POSITION_DDL}, shelf_category string, capacity int"),
    "store_assortment": _schema(f"store_id int, product_id string, {_POSITION_DDL}, active_flag boolean"),
    "inventory": _schema("store_id int, product_id string, stock_qty int, updated_at timestamp"),
    "suppliers": _schema("supplier_id string, supplier_name string, supplier_type string"),
    "product_suppliers": _schema("product_id string, supplier_id string, is_primary_supplier boolean"),
    "raw_movements": _schema(f"{_SOURCE_DDL}, {_MOVEMENT_DDL}, ingestion_timestamp timestamp"),
    "cleaned_movements": _schema(
        f"cleaned_movement_id bigint, {_SOURCE_DDL}, {_MOVEMENT_DDL}, loaded boolean, cleaned_at timestamp, "
        "loaded_at timestamp"
    ),
    "bad_movements": _schema(
        f"bad_movement_id bigint, {_SOURCE_DDL}, {_MOVEMENT_DDL}, error_reason string, error_details string, "
        "rejected_at timestamp, reviewed boolean, corrected boolean, correction_notes string"
    ),
    "movements": _schema(f"movement_id bigint, {_SOURCE_DDL}, {_MOVEMENT_DDL}, {_POSITION_DDL}"),
    "processed_files": _schema("file_name string, source_system string, processed_at timestamp"),
    "pipeline_runs": _schema(
        "run_id bigint, pipeline_step string, source_file_name string, status string, rows_processed bigint, "
        "rows_success bigint, rows_failed bigint, error_message string, started_at timestamp, "
        "completed_at timestamp, duration_seconds decimal(10,2)"
    ),
    "products_specifications": _schema(
        "product_id string, rotation_class string, spoilage_probability decimal(6,5), initial_stock int, "
        "minimum_stock_threshold int, reorder_lot int, assortment_flag boolean"
    ),
}
