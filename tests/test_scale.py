"""Plans and hot keys: what must hold when the data is large."""

import pytest
from pyspark.sql import functions as F

from storespark.operators import joins, rollup, validation
from storespark.operators.ranking import first_per_key
from storespark.plans import masterdata, views
from storespark.testbed import registry
from storespark.testbed.adapters import Testbed

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution has run it."""
    df.collect()
    return plan(df)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes") if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10000")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def hot_movements(spark, n=60000):
    """Half of all movements are of one product."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id as raw_movement_id", "'f.csv' as source_file_name", "1 as store_id",
        "case when id % 2 = 0 then 'hot' else cast(id % 997 as string) end as product_id",
        "cast(null as string) as supplier_id", "'sale' as movement_type", "cast(id % 5 + 1 as int) as quantity",
        "cast(1.5 as decimal(12,4)) as unit_sale_price", "cast(null as decimal(12,4)) as unit_purchase_price",
        "date_add(date'2024-01-01', cast(id % 30 as int)) as movement_date",
    )


def test_small_lookups_leave_movements_in_place(spark):
    t = Testbed(spark, SF_DIR).tables()
    checked = plan(validation.validate(t.raw_movements, t.products, t.suppliers))
    assert "SortMergeJoin" not in checked and checked.count("BroadcastHashJoin") == 2
    kpis = plan(views.sales_by_shelf_current(t))
    # one exchange for the sums, none of single movements
    assert kpis.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in kpis


def test_row_level_joins_scan_and_shuffle_the_fact_once(spark, no_broadcast, folder):
    """Per set of keys: one for positions, products and brands, two for products and suppliers."""
    t = Testbed(spark, SF_DIR).tables()
    t.movements.write.parquet(f"{folder}/fact")
    fact = spark.read.parquet(f"{folder}/fact")
    one = plan(views.shelf_movements_current(t.replaced(movements=fact)))
    assert one.count(f"{folder}/fact") == 1 and "promo_type" not in one
    raw = t.raw_movements
    raw.write.parquet(f"{folder}/raw")
    checked = plan(validation.validate(spark.read.parquet(f"{folder}/raw"), t.products, t.suppliers))
    assert checked.count(f"{folder}/raw") == 1 and checked.count("SortMergeJoin") == 2


def test_a_hot_key_is_split_by_adaptive_execution(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    moves = hot_movements(spark, 200_000)
    lookup = moves.select("store_id", "product_id").distinct().withColumn("v", F.lit(1))
    joined = joins.attach(moves, lookup, ["store_id", "product_id"])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 200_000
    spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionFactor")


def test_hot_product_is_summed_before_a_shuffle_join(spark, no_broadcast):
    moves = hot_movements(spark)
    keys = ["store_id", "product_id", "movement_date"]
    facts = rollup.additive(moves, keys)
    prices = moves.select("product_id").distinct().withColumn("purchase_price", F.lit(2).cast("decimal(12,4)"))
    lookup = rollup.Lookup(prices, ("product_id",))
    summed = rollup.summed_by(facts, keys, [lookup], ["store_id"], {"n": F.sum("n"), "qty": F.sum("qty")})
    text = plan(summed)
    # movements meet an aggregate before the join
    assert text.index("SortMergeJoin") < text.index("partial_sum(1)")
    assert tuple(summed.first()) == (1, 60000, moves.agg(F.sum("quantity")).first()[0])


def test_copies_collapse_before_the_shuffle(spark):
    rows = hot_movements(spark).select("product_id", "raw_movement_id", "quantity")
    text = plan(first_per_key(rows, "product_id", [F.col("raw_movement_id")]))
    assert "partial_min_by" in text and "Window" not in text


def test_no_cross_join_in_any_query(spark):
    skipped = {"stream_ingest", "stream_pipeline", "batch_load", "run_steps"}
    for key, query in registry.QUERIES.items():
        if key in skipped:
            continue
        text = plan(query(spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, key


def test_brand_search_is_one_scan_without_a_join(spark):
    bed = Testbed(spark, SF_DIR)
    text = plan(masterdata.branded(bed.price_rows()))
    assert "Join" not in text and "Exchange" not in text


def test_columns_are_pruned_at_the_scan(spark):
    t = Testbed(spark, SF_DIR).tables()
    text = plan(views.daily_kpis(t))
    assert "l_extendedprice" not in text and "l_linestatus" not in text


def test_samples_filter_one_scan_of_rows(spark, folder):
    """The ends are found before; the plan reads the rows and looks for brands once, with ties of different rows too."""
    rows = spark.range(4000).selectExpr("id", "id % 40 as id_prodotto", "concat('c', id % 2) as cat1", "id % 3 = 0 as brand_removed")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    found = masterdata.masterdata_concat(rows, {"c0": 0.33, "c1": 0.01})
    assert plan(found).count("FileScan") == 1 and "Join" not in plan(found)
    unbranded = {c: rows.where(f"cat1 = '{c}' and not brand_removed").count() for c in ("c0", "c1")}
    kept = {r["cat1"]: r["count"] for r in found.where("not brand_removed").groupBy("cat1").count().collect()}
    assert kept == {"c0": round(0.33 * unbranded["c0"]), "c1": round(0.01 * unbranded["c1"])}
    assert found.where("brand_removed").count() == rows.where("brand_removed").count()


def test_foreign_keys_read_every_table_once(spark, folder):
    from storespark.operators import audits
    from storespark.tables import Tables

    names = {name for name, _, _ in audits.FOREIGN_KEYS} | {target for _, _, target in audits.FOREIGN_KEYS}
    stored = Testbed(spark, SF_DIR).tables()
    for name in names:
        if name in stored:
            stored[name].write.parquet(f"{folder}/{name}")
    t = Tables({name: spark.read.parquet(f"{folder}/{name}") for name in names if name in stored})
    text = plan(audits.audit_foreign_keys(t))
    assert text.count("FileScan") == len([n for n in names if n in t]) and text.count("Exchange hashpartitioning") == 1


def test_audits_without_tables_are_empty(spark):
    from storespark.operators import audits
    from storespark.tables import Tables

    for audit in ("primary_keys", "unique", "foreign_keys", "domains", "price_rules", "not_null", "lengths"):
        assert getattr(audits, f"audit_{audit}")(Tables({})).isEmpty()


def test_masters_are_split_unless_a_cell_goes_over_lines(spark, tmp_path):
    from storespark.sources import csv_files

    for name, odd, cell in (("plain.csv", "tubo 5", "tubo 5"), ("lines.csv", '"tubo\n5 ""x"""', 'tubo\n5 "x"')):
        path = tmp_path / name
        path.write_text("brand_code,brand_name\n" + "".join(f"B{i:05d},name {i}\n" for i in range(60_000)) + f"B9,{odd}\n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
        try:
            found = csv_files.brands_csv(spark, str(path))
            tasks = found.rdd.getNumPartitions()
            assert found.count() == 60_001 and (tasks > 2) == (name == "plain.csv")
            assert found.where("brand_code = 'B9'").first()[1] == cell
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
