"""Store layout, shelf allocation, brand and supplier codes, product classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storespark.functions import fixed_values as fixed
from storespark.operators.joins import dealt, tasks_for
from storespark.operators.ranking import numbered


def layout_grid(stores: DataFrame) -> DataFrame:
    """All slots of each store; ``stores`` has store_id and optionally n_shelves."""
    shelves = F.col("n_shelves") if "n_shelves" in stores.columns else F.lit(fixed.SHELVES)
    zones = F.array(*[F.lit(z) for z in fixed.ZONES])
    rows = stores.select("store_id", F.explode(F.sequence(F.lit(1), shelves.cast("int"))).alias("shelf_id"))
    # the few rows of the stores lie in one task, which would make the slots of all
    slots = fixed.LEVELS * len(fixed.ZONES) * fixed.SLOTS
    return (
        dealt(rows, ["store_id", "shelf_id"], tasks_for(rows, times=slots))
        .withColumn("shelf_level", F.explode(F.sequence(F.lit(1), F.lit(fixed.LEVELS))))
        .withColumn("zone", F.explode(zones))
        .withColumn("slot_number", F.explode(F.sequence(F.lit(1), F.lit(fixed.SLOTS))))
        .withColumn("shelf_category", F.lit(None).cast("string"))
        .withColumn("capacity", F.lit(1))
    )


def layout_order(layout: DataFrame) -> DataFrame:
    return layout.orderBy("shelf_id", "shelf_level", "zone", "slot_number")


def assortment_candidates(products: DataFrame, specifications: DataFrame) -> DataFrame:
    return products.join(specifications.filter("assortment_flag"), "product_id")


def category_counts(candidates: DataFrame) -> DataFrame:
    """Products per category, largest first; a null category is not a group."""
    counted = candidates.filter(F.col("category_level_1").isNotNull()).groupBy("category_level_1")
    return counted.agg(F.count("*").alias("n_products")).orderBy(F.desc("n_products"), "category_level_1")


def shelf_allocation(counts: DataFrame, total_shelves: int = fixed.SHELVES) -> DataFrame:
    """Shelves per category in proportion to its products; the largest category takes the rounding rest."""
    total = counts.agg(F.sum("n_products")).scalar()
    share = F.col("n_products").cast("double") / total
    rounded = counts.withColumn("n_shelves", F.bround(share * total_shelves, 0).cast("int"))
    rest = rounded.agg(F.lit(total_shelves) - F.sum("n_shelves")).scalar()
    # the smallest name among the largest counts
    largest = counts.agg(
        F.min_by("category_level_1", F.struct(-F.col("n_products"), F.col("category_level_1")))
    ).scalar()
    extra = F.when(F.col("category_level_1") == largest, rest).otherwise(0)
    return rounded.select(
        "category_level_1", "n_products", (F.col("n_shelves") + extra).cast("int").alias("n_shelves")
    )


def shelf_category_map(allocation: DataFrame) -> DataFrame:
    """Consecutive shelf numbers for each category, largest category first.

    Only categories that hold a shelf are ordered, so the window sees no more
    rows than the store has shelves.
    """
    before = W.orderBy(F.desc("n_products"), "category_level_1").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_shelves").over(before), F.lit(0))
    placed = allocation.filter("n_shelves > 0").withColumn("_first", first)
    shelves = F.explode(F.expr("sequence(cast(_first as int) + 1, cast(_first as int) + n_shelves)"))
    return placed.select(shelves.alias("shelf_id"), F.col("category_level_1").alias("shelf_category"))


def distinct_brand_codes(products: DataFrame) -> DataFrame:
    return products.select("brand_code").filter(F.col("brand_code").isNotNull()).distinct().orderBy("brand_code")


def brand_names(products: DataFrame, names: list[str] | None = None) -> DataFrame:
    """A display name for each brand code: names are dealt in code order, with a number from the second round on."""
    names = names or fixed.BRAND_NAMES
    codes = products.select("brand_code").filter(F.col("brand_code").isNotNull()).distinct()
    i, n = F.col("i"), len(names)
    listed = F.array(*[F.lit(x) for x in names])
    name = F.element_at(listed, (i % n + 1).cast("int"))
    round_no = (F.floor(i / n) + 2).cast("string")
    return numbered(codes, "brand_code").select(
        "brand_code", F.when(i >= n, F.concat(name, F.lit(" "), round_no)).otherwise(name).alias("brand_name")
    )


def brand_head(brands: DataFrame, n: int = 10) -> DataFrame:
    return brands.orderBy("brand_code").limit(n)


def supplier_code(number: Column) -> Column:
    return F.format_string("SUP_%03d", number)


def supplier_name(number: Column) -> Column:
    """A letter per number: the character 64 places on, with the surrogates left out; beyond Unicode the number itself."""
    place = F.lit(64) + number
    place = F.when(place >= 0xD800, place + 0x800).otherwise(place)
    letter = F.decode(F.unhex(F.lpad(F.hex(place), 8, "0")), "UTF-32")  # Spark's chr wraps at 256
    return F.concat(F.lit("Fornitore "), F.when(place <= 0x10FFFF, letter).otherwise(number.cast("string")))


def supplier_list(numbers: DataFrame) -> DataFrame:
    """Supplier rows for a column ``n`` of numbers from 1; the first one is the primary supplier."""
    n = F.col("n")
    return numbers.select(
        supplier_code(n).alias("supplier_id"),
        supplier_name(n).alias("supplier_name"),
        F.when(n == 1, "primary").otherwise("secondary").alias("supplier_type"),
    )


def _rule_lookup(rules: list[tuple[str, str, str, str]], category: str) -> Column:
    """The rule of a category as a struct, from a literal map of a few dozen entries."""
    pairs = [x for key, *rule in rules for x in (F.lit(key), _rule_struct(*rule))]
    return F.when(F.col(category).isNotNull(), F.element_at(F.create_map(*pairs), F.col(category)))


def _rule_struct(rotation: str, low: str, high: str) -> Column:
    return F.struct(
        F.lit(rotation).alias("rotation_class"),
        F.lit(low).cast("decimal(6,5)").alias("spoilage_min"),
        F.lit(high).cast("decimal(6,5)").alias("spoilage_max"),
    )


def classify_products(products: DataFrame, rules: list[list[tuple]] | None = None) -> DataFrame:
    """Rotation class and spoilage range: the rule of the finest category that has one.

    ``rules`` are three rule tables (for category 1, 2, 3) in the layout of the fixed values.
    """
    tables = rules or [fixed.CATEGORY_1_RULES, fixed.CATEGORY_2_RULES, fixed.CATEGORY_3_RULES]
    finest_first = [
        _rule_lookup(table, f"category_level_{level}") for level, table in enumerate(tables, 1)
    ][::-1]
    rule = F.coalesce(*finest_first, _rule_struct(*fixed.DEFAULT_RULE))
    return products.withColumn("_rule", rule).select("product_id", "_rule.*")


def unique_products(assortment: DataFrame) -> DataFrame:
    return assortment.agg(F.count_distinct("product_id").alias("unique_products"))
