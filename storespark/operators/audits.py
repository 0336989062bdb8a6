"""Declared constraints as audits: each returns the rows or keys that break one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storespark.functions import fixed_values as fixed
from storespark.operators.joins import POSITION_KEY, fits_broadcast
from storespark.tables import Tables

PRIMARY_KEYS = {
    "products": ["product_id"],
    "brands": ["brand_code"],
    "store_layout": POSITION_KEY,
    "store_assortment": ["store_id", "product_id"],
    "inventory": ["store_id", "product_id"],
    "suppliers": ["supplier_id"],
    "product_suppliers": ["product_id", "supplier_id"],
    "products_specifications": ["product_id"],
    "processed_files": ["file_name"],
    "raw_movements": ["raw_movement_id"],
    "cleaned_movements": ["cleaned_movement_id"],
    "bad_movements": ["bad_movement_id"],
    "movements": ["movement_id"],
    "pipeline_runs": ["run_id"],
}
_SOURCE = ["source_file_name", "source_system"]
_MOVED = ["store_id", "product_id", "movement_type", "quantity", "is_promo", "movement_timestamp", "movement_date"]
# columns that must hold a value; a primary key's columns must too
NOT_NULL = {
    "products": ["product_description"],
    "store_layout": [],
    "store_assortment": POSITION_KEY[1:],
    "inventory": ["stock_qty"],
    "suppliers": ["supplier_name", "supplier_type"],
    "product_suppliers": ["is_primary_supplier"],
    "products_specifications": [
        "rotation_class", "spoilage_probability", "initial_stock", "minimum_stock_threshold", "reorder_lot",
    ],
    "raw_movements": [*_SOURCE, *_MOVED],
    "cleaned_movements": ["raw_movement_id", *_SOURCE, *_MOVED, "loaded"],
    "bad_movements": ["raw_movement_id", *_SOURCE, "error_reason", "reviewed", "corrected"],
    "movements": [*_SOURCE, *_MOVED],
    "processed_files": ["source_system"],
    "pipeline_runs": ["pipeline_step", "status", "started_at"],
}
_MOVED_LENGTHS = {
    "source_file_name": 255, "source_system": 50, "product_id": 50, "supplier_id": 20, "movement_type": 20,
    "promo_type": 50,
}
# most characters a column may hold
LENGTHS = {
    "products": {
        "product_id": 50, "category_level_1": 100, "category_level_2": 100, "category_level_3": 100,
        "unit_of_measure": 20, "brand_code": 20,
    },
    "store_layout": {"shelf_category": 100, "zone": 10},
    "store_assortment": {"product_id": 50, "zone": 10},
    "inventory": {"product_id": 50},
    "suppliers": {"supplier_id": 20, "supplier_name": 100, "supplier_type": 20},
    "product_suppliers": {"product_id": 50, "supplier_id": 20},
    "products_specifications": {"product_id": 50, "rotation_class": 20},
    "raw_movements": _MOVED_LENGTHS,
    "cleaned_movements": _MOVED_LENGTHS,
    "bad_movements": _MOVED_LENGTHS | {"error_reason": 255},
    "movements": _MOVED_LENGTHS | {"zone": 10},
    "processed_files": {"file_name": 255, "source_system": 50},
    "pipeline_runs": {"pipeline_step": 50, "source_file_name": 255, "status": 20},
}
UNIQUE = {
    "store_assortment": POSITION_KEY,
    "suppliers": ["supplier_name"],
    "cleaned_movements": ["raw_movement_id"],
    "bad_movements": ["raw_movement_id"],
    "movements": ["raw_movement_id"],
}
# (table, columns, referenced table)
FOREIGN_KEYS = [
    ("store_assortment", ["product_id"], "products"),
    ("store_assortment", POSITION_KEY, "store_layout"),
    ("inventory", ["product_id"], "products"),
    ("product_suppliers", ["product_id"], "products"),
    ("product_suppliers", ["supplier_id"], "suppliers"),
    ("products_specifications", ["product_id"], "products"),
    ("cleaned_movements", ["product_id"], "products"),
    ("cleaned_movements", ["supplier_id"], "suppliers"),
    ("cleaned_movements", ["raw_movement_id"], "raw_movements"),
    ("bad_movements", ["raw_movement_id"], "raw_movements"),
    ("movements", ["product_id"], "products"),
    ("movements", ["supplier_id"], "suppliers"),
    ("movements", ["raw_movement_id"], "raw_movements"),
]
_KINDS = ", ".join(f"'{k}'" for k in fixed.MOVEMENT_KINDS)
_ZONES = ", ".join(f"'{z}'" for z in fixed.ZONES)
DOMAINS = {
    "store_layout": {
        "shelf_level": "shelf_level between 1 and 5",
        "zone": f"zone in ({_ZONES})",
        "slot_number": "slot_number between 1 and 3",
        "capacity": "capacity > 0",
    },
    "inventory": {"stock_qty": "stock_qty >= 0"},
    "suppliers": {"supplier_type": "supplier_type in ('primary', 'secondary')"},
    "raw_movements": {"movement_type": f"movement_type in ({_KINDS})", "quantity": "quantity > 0"},
    "cleaned_movements": {"movement_type": f"movement_type in ({_KINDS})", "quantity": "quantity > 0"},
    "movements": {"movement_type": f"movement_type in ({_KINDS})", "quantity": "quantity > 0"},
    "products_specifications": {
        "rotation_class": "rotation_class in ('high', 'medium', 'low')",
        "spoilage_probability": "spoilage_probability >= 0 and spoilage_probability <= 1",
        "initial_stock": "initial_stock >= 0",
        "minimum_stock_threshold": "minimum_stock_threshold >= 0",
        "reorder_lot": "reorder_lot >= 0",
    },
}
PRICE_RULES = {
    "sale_price": "movement_type <> 'sale' or (unit_sale_price is not null and unit_sale_price > 0)",
    "purchase_price": "movement_type <> 'purchase' or (unit_purchase_price is not null and unit_purchase_price > 0)",
    "breakage_prices": "movement_type <> 'breakage' or (unit_sale_price is null and unit_purchase_price is null)",
}


#: tasks that share the rows of a key when many keys are compared
_PARTS = 16
_KEYS = "table_name string, key string, rows bigint"
_RULES = "table_name string, rule string, rows bigint"


def _union(parts: list[DataFrame], ddl: str) -> DataFrame:
    """All parts; without any table to look at, an empty result."""
    return reduce(DataFrame.unionByName, parts) if parts else SparkSession.active().createDataFrame([], ddl)


def _has(df: DataFrame, columns: list[str]) -> bool:
    """Whether a frame carries the columns of a constraint; a projection without them cannot break it."""
    return set(columns) <= set(df.columns)


def _key_text(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys held by more than one row; a key with a null part is not compared.

    Beyond the broadcast limit keys are dealt to all shuffle partitions. Adaptive execution would merge these by their
    compressed bytes, and keys are so regular that millions of them would come to one task. Rows of one key are counted
    in up to ``_PARTS`` tasks first.
    """
    known = df.dropna(subset=columns).select(*columns)
    rows = F.count("*").alias("rows")
    if fits_broadcast(known):
        return known.groupBy(*columns).agg(rows).filter("rows > 1")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = known.withColumn("_part", F.spark_partition_id() % _PARTS).repartition(n, *columns, "_part")
    counted = apart.groupBy(*columns, "_part").agg(rows)
    return counted.repartition(n, *columns).groupBy(*columns).agg(F.sum("rows").alias("rows")).filter("rows > 1")


def _duplicates(t: Tables, constraints: dict[str, list[str]]) -> DataFrame:
    parts = [
        duplicate_keys(t[name], columns).select(
            F.lit(name).alias("table_name"), _key_text(columns).alias("key"), "rows"
        )
        for name, columns in constraints.items()
        if name in t and _has(t[name], columns)
    ]
    return _union(parts, _KEYS)


def audit_primary_keys(t: Tables) -> DataFrame:
    return _duplicates(t, PRIMARY_KEYS)


def audit_unique(t: Tables) -> DataFrame:
    return _duplicates(t, UNIQUE)


def _sides(t: Tables) -> dict[str, list[tuple[int, bool, list[str]]]]:
    """Per table the foreign keys (number, whether the table refers, columns) that it takes part in."""
    sides: dict[str, list[tuple[int, bool, list[str]]]] = {}
    for number, (name, columns, target) in enumerate(FOREIGN_KEYS):
        if name in t and target in t and _has(t[name], columns) and _has(t[target], columns):
            sides.setdefault(name, []).append((number, True, columns))
            sides.setdefault(target, []).append((number, False, columns))
    return sides


def audit_foreign_keys(t: Tables) -> DataFrame:
    """Keys without a referenced row and the number of rows that use them; a key with a null part is exempt.

    Every table is read once, whatever the number of its keys: each row tells the keys it uses and the keys it is. Both
    sides meet in one shuffle, after sums per task, so a key that half of all rows use is one row a task there.
    """
    told = []
    for name, keys in _sides(t).items():
        each = [
            F.when(
                reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]),
                F.struct(
                    F.lit(number).alias("number"),
                    F.lit(refers).alias("refers"),
                    # the parts with their lengths, so that no two keys look alike
                    F.concat_ws(",", *[F.concat_ws(":", F.length(F.col(c).cast("string")), F.col(c).cast("string")) for c in columns]).alias("parts"),
                    _key_text(columns).alias("key"),
                ),
            )
            for number, refers, columns in keys
        ]
        told.append(t[name].select(F.explode(F.array(*each)).alias("k")).filter("k is not null").select("k.*"))
    sums = [F.count_if("refers").alias("rows"), F.min("refers").alias("_alone")]
    lost = _union(told, "number int, refers boolean, parts string, key string").groupBy("number", "parts", "key").agg(*sums)
    said = lambda i: F.element_at(F.array(*[F.lit(k[i]) for k in FOREIGN_KEYS]), F.col("number") + 1)
    return lost.filter("_alone").select(said(0).alias("table_name"), said(2).alias("referenced"), "key", "rows")


def _violations(df: DataFrame, name: str, checks: dict[str, str]) -> DataFrame:
    """Violations per check in one pass; a check that is null passes."""
    counted = df.agg(*[F.count_if(~F.expr(check)).alias(rule) for rule, check in checks.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("rows")) for r in checks]))
    return counted.select(F.lit(name).alias("table_name"), pairs.alias("_v")).select("table_name", "_v.rule", "_v.rows")


def audit_domains(t: Tables) -> DataFrame:
    """Rows outside the domain of each checked column, per table and column."""
    return _union([_violations(t[name], name, checks) for name, checks in DOMAINS.items() if name in t], _RULES)


def audit_price_rules(t: Tables, names: tuple[str, ...] = ("cleaned_movements", "movements")) -> DataFrame:
    return _union([_violations(t[name], name, PRICE_RULES) for name in names if name in t], _RULES)


def _present(t: Tables, name: str, checks: dict[str, str]) -> dict[str, str]:
    return {column: check for column, check in checks.items() if column in t[name].columns}


def audit_not_null(t: Tables) -> DataFrame:
    """Rows without a value, per table and required column; key columns are required."""
    parts = []
    for name, columns in NOT_NULL.items():
        required = dict.fromkeys([*PRIMARY_KEYS.get(name, []), *columns])
        checks = _present(t, name, {c: f"{c} is not null" for c in required}) if name in t else {}
        if checks:
            parts.append(_violations(t[name], name, checks))
    return _union(parts, _RULES)


def audit_lengths(t: Tables) -> DataFrame:
    """Rows with more characters than a column may hold, per table and column."""
    parts = []
    for name, limits in LENGTHS.items():
        checks = _present(t, name, {c: f"length({c}) <= {n}" for c, n in limits.items()}) if name in t else {}
        if checks:
            parts.append(_violations(t[name], name, checks))
    return _union(parts, _RULES)


def unchecked(t: Tables) -> list[tuple[str, str, str]]:
    """(audit, table, columns) of every constraint that no audit can look at, as the table or a column is absent."""
    wanted = [("primary key", n, c) for n, c in PRIMARY_KEYS.items()] + [("unique", n, c) for n, c in UNIQUE.items()]
    wanted += [("foreign key", n, c) for n, c, _ in FOREIGN_KEYS]
    wanted += [("not null", n, [c]) for n, columns in NOT_NULL.items() for c in columns]
    wanted += [("length", n, [c]) for n, limits in LENGTHS.items() for c in limits]
    wanted += [("domain", n, [c]) for n, checks in DOMAINS.items() for c in checks]
    return [(kind, n, ", ".join(c)) for kind, n, c in wanted if n not in t or not _has(t[n], c)]


def domain_violations(df: DataFrame, check: str) -> DataFrame:
    """The rows themselves that fail one check."""
    return df.filter(~F.expr(check))
