"""Joins go by the rows that tables hold, not by what the planner takes their files for."""

import pytest
from pyspark.sql import functions as F

from storespark import schemas
from storespark.operators import audits, joins, rollup, shelves
from storespark.plans import dashboards, views
from storespark.sources import csv_files
from storespark.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, folder):
    """Masters of 20,000 products whose files are far smaller than their rows, and a few movements."""
    n = 20_000
    product = F.col("id").cast("string").alias("product_id")
    spark.range(0, n, 1, 1).select(
        product, F.lit("a product with a name").alias("product_description"), F.lit("C1").alias("category_level_1"),
        F.lit("C2").alias("category_level_2"), F.lit("B1").alias("brand_code"),
        F.lit(2).cast("decimal(12,4)").alias("purchase_price"),
    ).write.parquet(f"{folder}/products")
    slot = F.col("id").cast("int")
    spark.range(0, n, 1, 1).select(
        F.lit(1).alias("store_id"), product, F.floor(slot / 45 + 1).cast("int").alias("shelf_id"),
        (F.floor(slot % 45 / 9) + 1).cast("int").alias("shelf_level"),
        F.element_at(F.array(*map(F.lit, ["left", "center", "right"])), (F.floor(slot % 9 / 3) + 1).cast("int")).alias("zone"),
        (slot % 3 + 1).cast("int").alias("slot_number"), F.lit(True).alias("active_flag"),
    ).write.parquet(f"{folder}/store_assortment")
    spark.range(0, n, 1, 1).select(F.lit(1).alias("store_id"), product, F.lit(1).alias("stock_qty")).write.parquet(f"{folder}/inventory")
    read = {name: spark.read.parquet(f"{folder}/{name}") for name in ("products", "store_assortment", "inventory")}
    moves = spark.range(100).select(
        F.lit(1).alias("store_id"), product, F.lit("sale").alias("movement_type"), F.lit(1).alias("quantity"),
        F.lit(3).cast("decimal(12,4)").alias("unit_sale_price"), F.to_date(F.lit("2024-01-01")).alias("movement_date"),
    )
    return Tables({
        **read, "movements": moves, "brands": spark.createDataFrame([("B1", "One")], "brand_code string, brand_name string"),
        "store_layout": shelves.layout_grid(spark.createDataFrame([(1, n // 45 + 1)], "store_id int, n_shelves int")),
    })


def test_a_lookup_of_small_files_and_many_rows_is_not_broadcast(store, monkeypatch):
    lookup = joins.active_positions(store.store_assortment)
    held = joins.held_bytes(lookup)
    assert held > 20_000 * 100 and joins.estimated_bytes(lookup) < held // 4
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", held - 1)
    assert not joins.fits_broadcast(lookup)
    text = plan(joins.attach(store.movements, lookup, ["store_id", "product_id"]))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    summed = rollup.summed_by(
        rollup.additive(store.movements, ["store_id", "product_id"]), ["store_id", "product_id"],
        [rollup.Lookup(lookup, ("store_id", "product_id"))], ["shelf_id"], {"n": F.sum("n")},
    )
    assert "BroadcastHashJoin" not in plan(summed) and summed.agg(F.sum("n")).first()[0] == 100
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", held)
    assert joins.fits_broadcast(lookup)
    assert "BroadcastHashJoin" in plan(joins.attach(store.movements, lookup, ["store_id", "product_id"]))


def test_long_texts_count_as_they_are(spark):
    short, long = (spark.range(10).select(F.repeat(F.lit("x"), F.lit(n)).alias("t")) for n in (1, 1001))
    assert joins.held_bytes(long) - joins.held_bytes(short) == 10_000
    assert joins.held_bytes(spark.range(0)) == 0 < joins.held_bytes(spark.createDataFrame([(None,)], "t string"))


@pytest.mark.parametrize("name, table", [
    ("shelf_mix_kpis", dashboards.shelf_mix_kpis), ("shelf_products_grid", dashboards.shelf_products_grid),
    ("share_of_sales", dashboards.share_of_sales), ("share_of_shelf", dashboards.share_of_shelf),
    ("inventory_by_shelf", views.inventory_by_shelf), ("shelf_detail", views.shelf_detail),
])
def test_layout_positions_and_stock_are_not_broadcast(store, monkeypatch, name, table):
    """The layout is one row to the planner, whatever the number of its slots."""
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 100_000)
    found = table(store)
    text = plan(found)
    assert "SortMergeJoin" in text
    # only the one brand may be
    assert text.count("BroadcastHashJoin") <= text.count("BroadcastHashJoin [brand_code"), text
    assert found.count() == {"shelf_products_grid": 20_000, "inventory_by_shelf": 20_000, "shelf_detail": 445 * 45}.get(name, 445)


def test_many_keys_are_not_merged_into_one_task(spark, monkeypatch):
    rows = spark.range(0, 3000, 1, 4).selectExpr("cast(if(id < 1000, null, if(id < 2000, 7, id)) as string) as k", "id % 2 as x")
    expected = [("7", 1000)]
    assert [tuple(r) for r in audits.duplicate_keys(rows, ["k"]).collect()] == expected
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    found = audits.duplicate_keys(rows, ["k"])
    assert [tuple(r) for r in found.collect()] == expected
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_only_rows_that_may_be_a_header_are_compared_with_it(spark, drops):
    """The cells of other rows are not trimmed and sorted one by one."""
    columns = schemas.MOVEMENT_COLUMNS
    row = dict.fromkeys(columns, "1")
    lines = [",".join(columns), ",".join(row.values()), ",".join({**row, columns[0]: columns[0]}.values()), ",".join({**row, columns[0]: columns[1]}.values())]
    folder = drops("movements_2024-01-01.csv", "\n".join(lines) + "\n")
    text = csv_files.movement_text(spark.read, [folder], csv_files.path_below(spark, folder))
    assert sorted(r[columns[0]] for r in text.collect()) == sorted(["1", columns[0], columns[1]])
    assert text.filter("other_header is not null").isEmpty()
    where = next(x for x in plan(text).splitlines() if "Filter" in x)
    assert where.index("CASE WHEN") < where.index("array(")
    other = ",".join(reversed(columns))
    folder = drops("movements_2024-01-02.csv", f"{other}\n")
    marked = csv_files.movement_text(spark.read, [f"{folder}/movements_2024-01-02.csv"], csv_files.path_below(spark, folder))
    assert [r["other_header"] for r in marked.collect()] == [other]


def test_tables_of_many_rows_are_dealt_to_tasks_that_grow_with_them(store, spark, monkeypatch):
    """Compressed bytes are few, so that adaptive execution would merge all rows into one task."""
    layout = store.store_layout
    held = joins.held_bytes(layout, store.inventory)
    assert held == joins.held_bytes(layout) + joins.held_bytes(store.inventory)
    assert joins.tasks_for(layout, store.inventory) == 0
    monkeypatch.setattr(joins, "TASK_BYTES", held // 10)
    few, most = (joins.tasks_for(layout, store.inventory, times=n) for n in (1, 6))
    assert 10 <= few <= 11 and 60 <= most <= 61
    monkeypatch.setattr(joins, "TASK_BYTES", held)
    assert joins.tasks_for(layout, store.inventory) == 0
    monkeypatch.setattr(joins, "TASK_BYTES", held - 1)
    assert joins.tasks_for(layout, store.inventory) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name, table, rows", [
    ("inventory_by_shelf", views.inventory_by_shelf, 20_000), ("shelf_detail", views.shelf_detail, 445 * 45),
    ("share_of_shelf", dashboards.share_of_shelf, 445), ("share_of_sales", dashboards.share_of_sales, 445),
    ("fill_pct", lambda t: joins.position_join(joins.stock_join(t.store_assortment, t.inventory), t.store_layout), 20_000),
])
def test_no_task_takes_the_rows_of_whole_tables(store, monkeypatch, name, table, rows):
    expected = sorted(map(str, table(store).collect()))
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 100_000)
    monkeypatch.setattr(joins, "TASK_BYTES", 500_000)
    found = table(store)
    tasks = found.rdd.getNumPartitions()
    sizes = found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert tasks >= 16 and max(sizes) < rows // 4, (tasks, sizes)
    assert sorted(map(str, found.collect())) == expected and len(expected) == rows


def test_layout_is_not_made_by_the_task_of_its_stores(spark, monkeypatch):
    stores = spark.createDataFrame([(1, 300), (2, 1)], "store_id int, n_shelves int").coalesce(1)
    expected = sorted(shelves.layout_grid(stores).collect())
    monkeypatch.setattr(joins, "TASK_BYTES", 100_000)
    grid = shelves.layout_grid(stores)
    sizes = grid.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) > 10 and max(sizes) < len(expected) // 4 and sorted(grid.collect()) == expected


def test_share_of_sales_keeps_items_without_a_code_and_without_sales(spark, store):
    """Only what has space counts; sums of a missing code meet the space of a missing code."""
    day = F.to_date(F.lit("2024-01-01"))
    codes = store.products.withColumn("brand_code", F.when(F.col("product_id") == "0", None).when(F.col("product_id") == "1", "B2").otherwise("B1"))
    moves = store.movements.filter("product_id in ('0', '2', '3')").withColumn("movement_date", day)
    off = store.store_assortment.withColumn("active_flag", F.col("product_id") != "3")
    t = store.replaced(products=codes, movements=moves, store_assortment=off.filter("cast(product_id as int) < 45"))
    found = {r.brand_code: (r.slots, float(r.revenue), float(r.sales_share_pct)) for r in dashboards.share_of_sales(t).collect()}
    assert found == {None: (1, 3.0, 50.0), "B1": (43, 3.0, 50.0), "B2": (1, 0.0, 0.0)}
