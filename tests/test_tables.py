import datetime as dt

import pytest
from pyspark.sql import functions as F

from storespark.functions.calendar import date_spine
from storespark.operators import audits, upserts
from storespark.plans.runlog import RunLog
from storespark.schemas import TABLES
from storespark.session import shared_folder
from storespark.sources import csv_files, writers
from storespark.tables import Tables


def test_writers(spark, folder):
    frame = spark.createDataFrame([("B1", "Uno"), ("B2", "Dué")], TABLES["brands"])
    assert writers.load_once(frame, folder) and not writers.load_once(frame, folder)
    writers.append_rows(frame, folder)
    assert spark.read.parquet(folder).count() == 4
    writers.full_refresh(frame, folder)
    assert spark.read.parquet(folder).count() == 2
    writers.replace_table(frame.select("brand_code"), folder, TABLES["brands"])
    stored = spark.read.parquet(folder)
    assert stored.columns == ["brand_code", "brand_name"] and stored.filter("brand_name is null").count() == 2
    csv = shared_folder(spark, "csv")
    writers.write_csv(frame, csv)
    assert sorted(tuple(r) for r in csv_files.brands_csv(spark, csv).collect()) == [("B1", "Uno"), ("B2", "Dué")]


def test_partition_overwrite_is_repeatable(spark, folder):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "f string, n int")
    for _ in range(2):
        writers.overwrite_partitions(rows, folder, ["f"])
    writers.overwrite_partitions(rows.filter("f = 'a'").withColumn("n", F.lit(9)), folder, ["f"])
    assert sorted(tuple(r) for r in spark.read.parquet(folder).select("f", "n").collect()) == [("a", 9), ("b", 2)]


def test_master_files(spark, drops):
    source = drops("products.csv", ",id_prodotto,descrizione,cat1,cat2,cat3,iva,pzxcar,um,costo,prezzo_vendita,brand\n"
                   "0,COD_1,latte,FRESCHI,NA,,4,6,PZ,0.85,1.2,B001\n")
    row = csv_files.products_master(spark, source).first()
    assert tuple(row) == ("COD_1", "latte", "FRESCHI", None, None, 4, "PZ", row.purchase_price, row.sale_price, "B001")
    assert (float(row.purchase_price), float(row.sale_price)) == (0.85, 1.2)
    prices = drops("list.txt", "Extra;ProductId;Description;Lev1Description;Lev2Description;Lev3Description;VatCode;PcsCar;"
                   "SaleUnitId;Brand;CurrentSalePrice;CurrentSellingPrice\nx;7;Pane;PANETTERIA;a;b;++;3;KG;0;1.1;2.2\n")
    row = csv_files.price_list(spark, f"{prices}/list.txt").first()
    assert (row.id_prodotto, row.iva, row.pzxcar, row.brand) == ("7", "++", 3, 0)


def test_upsert_adds_and_replaces(spark):
    brands = spark.createDataFrame([("B1", "a"), ("B2", "b")], TABLES["brands"])
    changes = spark.createDataFrame([("B2", "new"), ("B3", "c")], TABLES["brands"])
    got = sorted(tuple(r) for r in upserts.brands_upsert(brands, changes).collect())
    assert got == [("B1", "a"), ("B2", "new"), ("B3", "c")]


def test_run_log(spark, folder):
    log = RunLog(spark, folder).start()
    log.complete("extract", 5, 4, 1, "a.csv")
    log.start().fail("load", "boom")
    first, second = log.read().orderBy("run_id").collect()
    assert (first.run_id, first.status, first.rows_success, first.error_message) == (1, "success", 4, None)
    assert (second.run_id, second.status, second.rows_processed, second.error_message) == (2, "failed", None, "boom")
    assert second.completed_at >= second.started_at and second.duration_seconds >= 0


def test_date_spine(spark):
    bounds = spark.createDataFrame(
        [(1, dt.date(2024, 2, 28), dt.date(2024, 3, 1)), (2, dt.date(2024, 1, 2), dt.date(2024, 1, 1))],
        "store_id int, a date, b date",
    )
    got = [(r.store_id, str(r.movement_date)) for r in date_spine(bounds, "a", "b").collect()]
    assert got == [(1, "2024-02-28"), (1, "2024-02-29"), (1, "2024-03-01")]


def test_audits_find_each_fault(spark):
    t = Tables({
        "products": spark.createDataFrame([("A",), ("A",), ("B",)], "product_id string"),
        "suppliers": spark.createDataFrame(
            [("S1", "x", "primary"), ("S2", "x", "other"), ("S3", "y", None)], TABLES["suppliers"]),
        "product_suppliers": spark.createDataFrame(
            [("A", "S1"), ("Z", "S9"), (None, "S1")], "product_id string, supplier_id string"),
        "inventory": spark.createDataFrame([(1, "A", -1), (1, "B", 0)], "store_id int, product_id string, stock_qty int"),
    })
    assert [tuple(r) for r in audits.audit_primary_keys(t).collect()] == [("products", "A", 2)]
    assert [tuple(r) for r in audits.audit_unique(t).collect()] == [("suppliers", "x", 2)]
    orphans = sorted(tuple(r) for r in audits.audit_foreign_keys(t).collect())
    assert orphans == [("product_suppliers", "products", "Z", 1), ("product_suppliers", "suppliers", "S9", 1)]
    domains = {(r.table_name, r.rule): r.rows for r in audits.audit_domains(t).collect()}
    assert domains == {("inventory", "stock_qty"): 1, ("suppliers", "supplier_type"): 1}


def test_cascade_delete(spark):
    t = Tables({
        "products": spark.createDataFrame([("A",), ("B",)], "product_id string"),
        "suppliers": spark.createDataFrame([("S1",), ("S2",)], "supplier_id string"),
        "product_suppliers": spark.createDataFrame([("A", "S1"), ("B", "S2")], "product_id string, supplier_id string"),
        "movements": spark.createDataFrame(
            [("A", "S1", 1), ("B", "S1", 2), ("B", None, 3), ("B", "S2", 4)], "product_id string, supplier_id string, n int"),
    })
    left = upserts.cascade_delete(t, t.products.filter("product_id = 'A'"), t.suppliers.filter("supplier_id = 'S1'"))
    kept = sorted((r.n, r.supplier_id) for r in left.movements.collect())
    assert kept == [(2, None), (3, None), (4, "S2")]
    assert [tuple(r) for r in left.product_suppliers.collect()] == [("B", "S2")]
    assert [r.supplier_id for r in left.suppliers.collect()] == ["S2"]


def test_tables(spark, folder):
    frame = spark.createDataFrame([("B1", "Uno")], TABLES["brands"])
    writers.append_rows(frame, f"{folder}/brands")
    t = Tables.from_parquet(spark, folder, ["brands"])
    assert t.brands.count() == 1 and list(t) == ["brands"] and len(t) == 1
    with pytest.raises(AttributeError):
        t.movements
