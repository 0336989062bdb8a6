"""One query per operator over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storespark import schemas
from storespark.functions import calendar, money, text
from storespark.functions import fixed_values as fixed
from storespark.operators import audits, fileset, joins, movement_sums, ranking, shelves, stock, upserts, validation
from storespark.plans import dashboards, masterdata, runlog, views
from storespark.plans.pipeline import Warehouse
from storespark.plans.replenishment import replenishment_candidates
from storespark.schemas import MOVEMENT_COLUMNS, PRICE_LIST_COLUMNS, PRODUCT_MASTER_COLUMNS
from storespark.session import shared_folder
from storespark.sources import csv_files, writers
from storespark.streaming.ingest import stream_ingest, stream_pipeline
from storespark.tables import Tables
from storespark.testbed.oracle import NULLABLE
from storespark.testbed.adapters import CLASS_RULES, SHARES, SPELLINGS, STORES, Testbed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def load_time() -> Column:
    return F.lit("2024-03-01").cast("timestamp")


CUT = "movements_2024-01-15.csv"
EARLY = "movements_2024-01-10.csv"
LINE = ["store_id", "product_id", "movement_type", "quantity", "movement_date"]
SLOT = ["store_id", "shelf_id", "shelf_level", "zone", "slot_number"]


def portable(df: DataFrame, nullable: list[str]) -> DataFrame:
    """Dates and times as text, money and the ``nullable`` columns as double, which every engine compares alike."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        elif isinstance(f.dataType, T.DecimalType) or f.name in nullable:
            c = c.cast("double").alias(f.name)
        columns.append(c)
    return df.select(*columns)


def register(name: str | None = None):
    """Register a function of (testbed, tables)."""

    def add(f: Callable[[Testbed, Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            bed = Testbed(spark, folder)
            return portable(f(bed, bed.tables()), NULLABLE.get(key, []))

        key = name or f.__name__
        QUERIES[key] = run
        return f

    return add


def add(name: str, f: Callable[[Testbed, Tables], DataFrame]) -> None:
    register(name)(f)


# ---- sources and sinks ------------------------------------------------------------------------


def movement_folder(bed: Testbed, t: Tables) -> str:
    """Raw movements as CSV drops, one per day, in a new shared folder."""
    folder = shared_folder(bed.spark, "drops")
    rows = t.raw_movements.select(F.col("source_file_name").alias("drop"), *MOVEMENT_COLUMNS)
    writers.write_csv(rows, folder, partition_by=["drop"])
    return folder


@register()
def source_files(bed, t):
    return csv_files.source_files(bed.spark, movement_folder(bed, t))


@register()
def raw_ingest(bed, t):
    return csv_files.raw_ingest(bed.spark, movement_folder(bed, t)).drop("violation")


@register()
def products_master(bed, t):
    folder = shared_folder(bed.spark, "master")
    italian = {new: old for old, new in PRODUCT_MASTER_COLUMNS.items()}
    writers.write_csv(t.products.withColumnsRenamed(italian), folder)
    return csv_files.products_master(bed.spark, folder)


@register()
def price_list(bed, t):
    folder = shared_folder(bed.spark, "prices")
    original = {new: old for old, new in PRICE_LIST_COLUMNS.items()}
    writers.write_csv(bed.price_rows().withColumnsRenamed(original), folder, sep=";")
    return csv_files.price_list(bed.spark, folder)


add("raw_for_file", lambda bed, t: fileset.raw_for_file(t.raw_movements, CUT))
add("unloaded_movements", lambda bed, t: stock.unloaded_movements(t.cleaned_movements).drop("loaded", "loaded_at"))


@register()
def brands_csv(bed, t):
    folder = shared_folder(bed.spark, "brands")
    writers.write_csv(t.brands, folder)
    return csv_files.brands_csv(bed.spark, folder)


@register()
def stored_tables(bed, t):
    root = shared_folder(bed.spark, "tables")
    for name in ("brands", "products"):
        writers.full_refresh(t[name], f"{root}/{name}")
    stored = Tables.from_parquet(bed.spark, root, ["brands", "products"])
    counts = [stored[n].agg(F.lit(n).alias("table_name"), F.count("*").alias("rows")) for n in ("brands", "products")]
    return counts[0].unionByName(counts[1])


def written(bed: Testbed, first: DataFrame, *steps: Callable[[str], object]) -> DataFrame:
    """What a folder holds after ``first`` was written and the steps were done to it."""
    path = shared_folder(bed.spark, "sink")
    writers.append_rows(first, path)
    for step in steps:
        step(path)
    return bed.spark.read.parquet(path)


@register()
def append_rows(bed, t):
    return written(bed, t.brands, lambda path: writers.append_rows(t.brands, path))


@register()
def full_refresh(bed, t):
    return written(bed, t.brands, lambda path: writers.full_refresh(t.brands.filter("brand_code > 'B2'"), path))


@register()
def overwrite_partitions(bed, t):
    path = shared_folder(bed.spark, "sink")
    rows = t.products.filter("category_level_1 is not null").select("product_id", "category_level_1", "unit_of_measure")
    writers.append_rows(rows, path, ["category_level_1"])
    new = rows.filter("category_level_1 = 'PROMO'").withColumn("unit_of_measure", F.lit("new"))
    writers.overwrite_partitions(new, path, ["category_level_1"])
    return bed.spark.read.schema(rows.schema).parquet(path)


@register()
def replace_table(bed, t):
    only_codes = t.brands.select("brand_code")
    return written(bed, t.brands, lambda path: writers.replace_table(only_codes, path, schemas.TABLES["brands"]))


@register()
def load_once(bed, t):
    return written(bed, t.brands, *[lambda path: writers.load_once(t.brands, path)] * 2)


@register()
def write_csv(bed, t):
    folder = shared_folder(bed.spark, "csv")
    quoted = F.concat(F.lit('He said "'), F.col("descrizione"), F.lit('"; \ndone'))
    rows = bed.price_rows().select("id_prodotto", quoted.alias("descrizione"))
    writers.write_csv(rows, folder, sep=";")
    reader = bed.spark.read.option("header", True).option("multiLine", True).option("sep", ";")
    return reader.options(**csv_files.DIALECT).csv(folder)


@register()
def brands_upsert(bed, t):
    changes = bed.source("part").filter("p_type in ('PROMO', 'SMALL')").selectExpr(
        "concat('B', substr(p_brand, 7), '-', p_type) as brand_code", "concat('New ', p_type) as brand_name"
    )
    return upserts.brands_upsert(t.brands, changes.distinct())


def file_names(t: Tables) -> DataFrame:
    return t.raw_movements.select(F.col("source_file_name").alias("file_name")).distinct()


def half_ledger(t: Tables) -> DataFrame:
    done = file_names(t).filter(F.col("file_name") < CUT)
    return done.withColumns({"source_system": F.lit(fixed.SOURCE_SYSTEM), "processed_at": load_time()})


@register()
def mark_file_processed(bed, t):
    ledger = half_ledger(t)
    new = joins.new_files(file_names(t), ledger)
    return fileset.mark_file_processed(ledger, new, fixed.SOURCE_SYSTEM, load_time()).drop("processed_at")


def applied(t: Tables) -> DataFrame:
    return stock.inventory_apply(t.inventory, stock.net_stock_delta(t.movements), load_time())


add("inventory_apply", lambda bed, t: applied(t).drop("updated_at"))
add("touch_updated_at", lambda bed, t: applied(t).drop("stock_qty"))


@register()
def mark_loaded(bed, t):
    ids = t.cleaned_movements.filter("raw_movement_id % 5 = 1")
    marked = stock.mark_loaded(t.cleaned_movements, ids, load_time())
    return marked.select("cleaned_movement_id", "loaded", "loaded_at")


# ---- rules and projections --------------------------------------------------------------------

for _rule in fixed.RULE_TEXTS:
    add(
        f"validate_{_rule}",
        lambda bed, t, rule=_rule: validation.rule_breakers(t.raw_movements, t.products, t.suppliers, rule).select(
            "raw_movement_id", "product_id", "supplier_id", "movement_type"
        ),
    )

add("validate_split", lambda bed, t: bed.validated().select("raw_movement_id", "error_reason", "error_details"))
add("cleaned_projection", lambda bed, t: validation.cleaned_projection(validation.clean_rows(bed.validated())))
add("bad_projection", lambda bed, t: validation.bad_projection(validation.bad_rows(bed.validated())))
add(
    "movements_projection",
    lambda bed, t: validation.movements_projection(
        joins.enrich_shelf_position(t.cleaned_movements, t.store_assortment)
    ),
)
add(
    "movement_type_filter",
    lambda bed, t: views.of_type(bed.lines(), "sale").unionByName(views.of_type(bed.lines(), "breakage")).select(*LINE),
)
add("shelf_not_null", lambda bed, t: t.movements.filter(F.col("shelf_id").isNotNull()).select(*LINE, "shelf_id"))
add("active_assortment", lambda bed, t: joins.active_positions(t.store_assortment))
add(
    "assortment_candidates",
    lambda bed, t: shelves.assortment_candidates(t.products, t.products_specifications).select(
        "product_id", "category_level_1", "rotation_class"
    ),
)
add(
    "category_exclude",
    lambda bed, t: masterdata.unbranded_source(bed.price_rows()).filter(
        masterdata.category_exclude(F.col("cat1"), ["LARGE", "PROMO"])
        & masterdata.category_exclude(F.col("iva"), [fixed.COMPOSITE_VAT])
    ).select("id_prodotto", "cat1", "iva"),
)


def noisy(bed: Testbed) -> DataFrame:
    return masterdata.noisy_prices(masterdata.unbranded_source(bed.price_rows()))


add("positive_prices", lambda bed, t: masterdata.positive_prices(noisy(bed)).select("id_prodotto", "costo", "prezzo_vendita"))


@register()
def dashboard_filter(bed, t):
    chosen = dashboards.dashboard_filter(t.movements, shelf_id=3, month="1998-03", year=1998)
    by_shelf = views.sales_by_shelf_historical(t.replaced(movements=chosen))
    return by_shelf.select("store_id", "shelf_id", "movement_date", "transaction_count")


# ---- joins ------------------------------------------------------------------------------------

add("new_files", lambda bed, t: joins.new_files(file_names(t), half_ledger(t)))


@register()
def valid_keys(bed, t):
    marked = validation.with_known_keys(t.raw_movements, t.products, t.suppliers)
    flags = {"known_product": F.col("_known_product").isNotNull(), "known_supplier": F.col("_known_supplier").isNotNull()}
    return marked.withColumns(flags).groupBy(*flags).agg(F.count("*").alias("rows"))


add("enrich_shelf_position", lambda bed, t: t.movements.select(*LINE, "shelf_id", "shelf_level", "zone", "slot_number"))
add(
    "movements_products",
    lambda bed, t: joins.movements_products(
        bed.lines().select(*LINE), t.products, "product_description", "purchase_price"
    ),
)
add(
    "movements_current_position",
    lambda bed, t: joins.movements_current_position(bed.lines().select(*LINE), t.store_assortment, "shelf_id", "zone"),
)
add(
    "position_join",
    lambda bed, t: joins.position_join(t.store_assortment, t.store_layout).select("product_id", *SLOT, "capacity"),
)
add(
    "layout_left_assortment",
    lambda bed, t: joins.attach(
        joins.layout_left_assortment(t.store_layout, t.store_assortment), t.products, ["product_id"], "left"
    ).select(*SLOT, "product_id", "active_flag", "product_description"),
)
add(
    "brand_left_join",
    lambda bed, t: joins.brand_left_join(t.products, t.brands).select("product_id", "brand_code", "brand_name"),
)
add(
    "stock_join",
    lambda bed, t: joins.stock_join(joins.active_positions(t.store_assortment), t.inventory).select(
        *SLOT, "product_id", "stock_qty"
    ),
)
add("layout_grid", lambda bed, t: shelves.layout_grid(bed.stores()))


# ---- aggregations -----------------------------------------------------------------------------

add("net_stock_delta", lambda bed, t: stock.net_stock_delta(bed.lines()))


add("conditional_counts", lambda bed, t: movement_sums.movement_counts(bed.lines(), "store_id"))
add("conditional_sums", lambda bed, t: movement_sums.movement_sums(bed.lines(), "store_id", "movement_type"))
add("sum_product", lambda bed, t: movement_sums.revenue(bed.lines(), "store_id", "product_id"))


@register()
def margin_pct(bed, t):
    sums = views.margins_by_product_shelf(t).groupBy("store_id", "product_id").agg(
        money.money_sum(F.col("revenue")).alias("revenue"), money.money_sum(F.col("cost")).alias("cost")
    )
    return sums.withColumn("margin_pct", money.margin_pct(F.col("revenue"), F.col("cost")))


@register()
def fill_pct(bed, t):
    tasks = joins.tasks_for(t.store_assortment, t.inventory, t.store_layout)
    placed = joins.position_join(joins.stock_join(t.store_assortment, t.inventory, tasks), t.store_layout, tasks)
    return placed.select(
        "store_id", "product_id", "capacity", money.fill_pct(F.col("stock_qty"), F.col("capacity")).alias("fill_pct")
    )


def categories(t: Tables) -> DataFrame:
    return shelves.category_counts(shelves.assortment_candidates(t.products, t.products_specifications))


add("category_counts", lambda bed, t: categories(t))
add("shelf_allocation", lambda bed, t: shelves.shelf_allocation(categories(t)))
add("table_row_count", lambda bed, t: fileset.table_row_count(bed.lines()))
add("unique_products", lambda bed, t: shelves.unique_products(t.store_assortment))
add("validation_counts", lambda bed, t: validation.validation_counts(bed.validated()))


# ---- ranks, sorts, sets -----------------------------------------------------------------------

add("shelf_category_map", lambda bed, t: shelves.shelf_category_map(shelves.shelf_allocation(categories(t))))
add("brand_names", lambda bed, t: shelves.brand_names(t.products))


@register()
def sample_by_category(bed, t):
    rows = masterdata.branded(masterdata.unbranded_source(bed.price_rows()), SPELLINGS).filter("not brand_removed")
    order = text.hash_order(F.col("id_prodotto"), 42)
    return ranking.sample_by_category(rows, "cat1", order, SHARES).select("id_prodotto", "cat1")


add("files_in_order", lambda bed, t: fileset.files_in_order(file_names(t)))
add("brand_head", lambda bed, t: shelves.brand_head(t.brands))
add("distinct_brand_codes", lambda bed, t: shelves.distinct_brand_codes(t.products))
add("layout_order", lambda bed, t: shelves.layout_order(t.store_layout).select(*SLOT))


@register()
def files_to_transform(bed, t):
    checked, name = bed.validated(), F.col("source_file_name")
    cleaned = validation.clean_rows(checked).filter(name < EARLY)
    return fileset.files_to_transform(t.raw_movements, cleaned, validation.bad_rows(checked).filter(name < CUT))


@register()
def masterdata_concat(bed, t):
    rows = masterdata.branded(masterdata.unbranded_source(bed.price_rows()), SPELLINGS)
    return masterdata.masterdata_concat(rows, SHARES).select("id_prodotto", "cat1", "brand_anon")


@register()
def dedupe_products(bed, t):
    columns = ["product_id", "movement_date", "store_id", "quantity"]
    return ranking.first_per_key(bed.lines().select(*columns), "product_id", [F.col(c) for c in columns[1:]])


# ---- scalar functions -------------------------------------------------------------------------


def calendar_rows(bed: Testbed, *keys: str) -> DataFrame:
    return calendar.with_calendar(bed.lines()).groupBy(*keys).agg(F.count("*").alias("rows"))


add("month_key", lambda bed, t: calendar_rows(bed, "month"))
add("year_key", lambda bed, t: calendar_rows(bed, "year"))
add("iso_week", lambda bed, t: calendar_rows(bed, "year", "week"))
add(
    "pseudonymise_id",
    lambda bed, t: t.products.select("product_id", text.pseudonymise_id(F.col("product_id")).alias("pseudonym")),
)
add(
    "price_noise",
    lambda bed, t: masterdata.unbranded_source(bed.price_rows()).select(
        "id_prodotto", text.price_noise(F.col("id_prodotto")).alias("step")
    ),
)
add(
    "round_prices",
    lambda bed, t: t.products.select(
        "product_id", money.half_even_cents(F.col("sale_price") * F.lit("0.125").cast("decimal(4,3)")).alias("price")
    ),
)


def described(f) -> Callable:
    return lambda bed, t: bed.price_rows().select("id_prodotto", f(F.col("descrizione")).alias("descrizione"))


add("normalise_description", described(text.normalise_description))
add("strip_brand", described(lambda c: text.strip_brand(F.lower(c), SPELLINGS)))


def of_list(values: list[str], step: int):
    """One of the values by part number; none for every (n + 1)th."""
    return F.get(F.array(*map(F.lit, values)), ((F.col("p_partkey") * step) % (len(values) + 1)).cast("int"))


def named_parts(bed):
    """Part names with one of the default spellings among their words, in capitals or not, and every third time two."""
    spellings = [s for s, _ in fixed.brand_spellings()]
    key, word = F.col("p_partkey"), lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    first, second = of_list(spellings, 1), F.when(key % 3 == 0, of_list(spellings, 7))
    first = F.when(key % 2 == 0, F.upper(first)).otherwise(first)
    words = F.concat_ws(" ", word(1), first, word(2), second, F.lit("500 g"))
    return bed.source("part").select(key.cast("string").alias("product_id"), words.alias("descrizione"))


def categorised(bed):
    """Parts under the categories of the default rules."""
    tables = (fixed.CATEGORY_1_RULES, fixed.CATEGORY_2_RULES, fixed.CATEGORY_3_RULES)
    levels = [of_list([rule[0] for rule in table], step).alias(f"category_level_{n}") for n, (table, step) in enumerate(zip(tables, (1, 3, 5)), 1)]
    return bed.source("part").select(F.col("p_partkey").cast("string").alias("product_id"), *levels)


add("squeeze_spaces", described(text.squeeze_spaces))
add("truncate_description", described(text.truncate_description))
add(
    "extract_brand",
    lambda bed, t: bed.price_rows().select(
        "id_prodotto", text.extract_brand(F.lower("descrizione"), SPELLINGS).alias("brand_anon")
    ),
)
add(
    "extract_brand_default",
    lambda bed, t: named_parts(bed).select("product_id", text.extract_brand(F.lower("descrizione")).alias("brand_anon")),
)
add(
    "brand_removed_flag",
    lambda bed, t: masterdata.branded(bed.price_rows(), SPELLINGS).select("id_prodotto", "brand_removed"),
)


@register()
def rename_categories(bed, t):
    source = F.when(F.col("cat1") == "SMALL", "BLS").when(F.col("cat1") == "LARGE", "SA.FO").otherwise(F.col("cat1"))
    return bed.price_rows().select("id_prodotto", text.rename_categories(source).alias("cat1"))


add("opening_stock", lambda bed, t: stock.opening_stock(t.products_specifications, STORES))
add("classify_products_default", lambda bed, t: shelves.classify_products(categorised(bed)))
add("classify_products", lambda bed, t: shelves.classify_products(t.products, CLASS_RULES))
add(
    "supplier_code",
    lambda bed, t: shelves.supplier_list(bed.source("supplier").selectExpr("cast(s_suppkey + 1 as int) as n")),
)
add(
    "clamp_threshold",
    lambda bed, t: t.products_specifications.select(
        "product_id",
        stock.clamp_threshold(
            F.col("initial_stock"), F.col("minimum_stock_threshold"), F.col("assortment_flag")
        ).alias("minimum_stock_threshold"),
    ),
)


@register()
def date_spine(bed, t):
    bounds = bed.lines().groupBy("store_id").agg(
        F.min("movement_date").alias("first"), F.max("movement_date").alias("last")
    )
    days = calendar.date_spine(bounds, "first", "last")
    revenue = views.daily_kpis(t).select("store_id", "movement_date", "revenue")
    return days.join(revenue, ["store_id", "movement_date"], "left").select(
        "store_id", "movement_date", F.coalesce("revenue", F.lit(0)).cast(money.MONEY).alias("revenue")
    )


# ---- audits -----------------------------------------------------------------------------------


@register()
def audit_primary_keys(bed, t):
    # a stock table written once per movement instead of once per product
    return audits.audit_primary_keys(t.replaced(inventory=bed.lines()))


@register()
def audit_unique(bed, t):
    loaded = t.cleaned_movements.filter("loaded").select("raw_movement_id")
    return audits.audit_unique(
        t.replaced(
            store_assortment=t.store_assortment.unionByName(t.past_assortment),
            movements=t.raw_movements.select("raw_movement_id").unionByName(loaded),
        )
    )


add("audit_foreign_keys", lambda bed, t: audits.audit_foreign_keys(t))
add("audit_domains", lambda bed, t: audits.audit_domains(t))
add("audit_not_null", lambda bed, t: audits.audit_not_null(t))
add("audit_lengths", lambda bed, t: audits.audit_lengths(t))
add("audit_price_rules", lambda bed, t: audits.audit_price_rules(t, ("raw_movements", "movements")))


@register()
def cascade_delete_rows(bed, t):
    fact = t.raw_movements.select("raw_movement_id")
    gone = t.raw_movements.filter("movement_type = 'breakage'")
    left = upserts.cascade_delete(
        t.replaced(movements=fact), slots=t.store_layout.filter("shelf_level = 1"), raw_rows=gone
    )
    counts = {n: left[n] for n in ("store_layout", "store_assortment", "raw_movements", "cleaned_movements")}
    counts["movements without raw row"] = left.movements.filter("raw_movement_id is null")
    parts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("rows")) for n, df in counts.items()]
    return reduce(DataFrame.unionByName, parts)


@register()
def cascade_delete(bed, t):
    gone = t.products.filter("category_level_1 = 'LARGE'")
    left = upserts.cascade_delete(
        t.replaced(movements=bed.lines()), gone, t.suppliers.filter("supplier_type = 'secondary'")
    )
    lost = F.count_if((F.col("movement_type") == "purchase") & F.col("supplier_id").isNull())
    parts = [
        left[name].agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("rows"),
            (lost if name == "movements" else F.lit(0).cast("bigint")).alias("without_supplier"),
        )
        for name in ("inventory", "movements", "product_suppliers", "store_assortment")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---- analytic tables --------------------------------------------------------------------------

for _name, _view in views.VIEWS.items():
    add(_name, lambda bed, t, view=_view: view(t))

add("overview_totals", lambda bed, t: dashboards.overview_totals(t))
add("overview_trend", lambda bed, t: dashboards.overview_trend(t, "month"))
add("overview_trend_week", lambda bed, t: dashboards.overview_trend(t, "week"))
add("overview_trend_day", lambda bed, t: dashboards.overview_trend(t, "day"))
add("shelf_products_grid", lambda bed, t: dashboards.shelf_products_grid(t))
add("shelf_products_grid_week", lambda bed, t: dashboards.shelf_products_grid(t, shelf_id=7, year=1998, week=1))
add("shelf_level_kpis", lambda bed, t: dashboards.shelf_level_kpis(t))
add("shelf_level_totals", lambda bed, t: dashboards.shelf_level_kpis(t, by_zone=False))
add("share_of_shelf", lambda bed, t: dashboards.share_of_shelf(t))
add("share_of_shelf_category", lambda bed, t: dashboards.share_of_shelf(t, "category"))
add("share_of_sales", lambda bed, t: dashboards.share_of_sales(t))
add("share_of_sales_category", lambda bed, t: dashboards.share_of_sales(t, "category"))
add("shelf_mix_kpis", lambda bed, t: dashboards.shelf_mix_kpis(t))


@register()
def pipeline_runs(bed, t):
    start = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    end = start + dt.timedelta(seconds=12, microseconds=345000)
    counts = validation.validation_counts(bed.validated()).withColumn("error_message", F.lit(None).cast("string"))
    return runlog.run_rows(counts, "transform", start, end)


add("replenishment_candidates", lambda bed, t: replenishment_candidates(t))
add(
    "product_registry",
    lambda bed, t: masterdata.product_registry(bed.price_rows(), SPELLINGS, SHARES, ["MEDIUM"]),
)


# ---- pipelines --------------------------------------------------------------------------------


def new_warehouse(bed: Testbed, t: Tables) -> Warehouse:
    warehouse = Warehouse(bed.spark, shared_folder(bed.spark, "warehouse"))
    for name in ("products", "suppliers", "store_assortment"):
        warehouse.put_table(name, t[name])
    warehouse.set_inventory(t.inventory)
    return warehouse


RAW_OUT = ["source_file_name", "source_system", *MOVEMENT_COLUMNS]


@register("stream_ingest")
def _stream_ingest(bed, t):
    warehouse = Warehouse(bed.spark, shared_folder(bed.spark, "warehouse"))
    stream_ingest(warehouse, movement_folder(bed, t), shared_folder(bed.spark, "stream")).awaitTermination()
    return warehouse.raw_movements().select(*RAW_OUT)


@register("stream_pipeline")
def _stream_pipeline(bed, t):
    warehouse = new_warehouse(bed, t)
    stream_pipeline(warehouse, movement_folder(bed, t), shared_folder(bed.spark, "stream")).awaitTermination()
    return warehouse.movements().select(*RAW_OUT, "shelf_id", "shelf_level", "zone", "slot_number")


@register()
def run_steps(bed, t):
    """Runs and rows per step in the log of a whole batch."""
    warehouse = new_warehouse(bed, t)
    warehouse.run(movement_folder(bed, t))
    return warehouse.runs.read().groupBy("pipeline_step").agg(
        F.count("*").alias("runs"), F.sum("rows_processed").alias("rows_processed")
    )


@register()
def batch_load(bed, t):
    warehouse = new_warehouse(bed, t)
    warehouse.run(movement_folder(bed, t))
    return warehouse.inventory().drop("updated_at")
