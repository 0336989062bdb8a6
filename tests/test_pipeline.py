import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from storespark.operators.audits import audit_unique
from storespark.plans import pipeline
from storespark.plans.pipeline import Warehouse
from storespark.plans.views import daily_kpis
from storespark.session import shared_folder
from storespark.sources import csv_files
from storespark.streaming.ingest import stream_ingest, stream_pipeline

HEADER = (
    "store_id,product_id,supplier_id,movement_type,quantity,unit_sale_price,unit_purchase_price,is_promo,promo_type,"
    "movement_timestamp,movement_date\n"
)
DAY1 = HEADER + (
    "1,P1,,sale,2,1.5,,True,offerta_3x2,2024-01-01T09:00:00.123456,2024-01-01\n"
    "1,P1,,sale,2,1.5,,True,offerta_3x2,2024-01-01T09:00:00.123456,2024-01-01\n"
    "1,P2,NA,sale,1,null,,False,,2024-01-01 10:00:00,2024-01-01\n"
    "1,P3,S1,purchase,4.0,,0.75,False,None,2024-01-01 11:00:00,2024-01-01\n"
)
DAY2 = HEADER + (
    "1,P1,,breakage,1,,,False,,2024-01-02 08:00:00,2024-01-02\n"
    "1,NOPE,,sale,1,2,,False,,2024-01-02 08:00:00,2024-01-02\n"
    "1,P3,,sale,9,2,,False,,2024-01-02 08:00:00,2024-01-02\n"
)
BROKEN = HEADER + (
    "1,P1,,sale,1,2,,False,,2024-01-03 08:00:00,2024-01-03\n"
    "1,P1,,gift,1,2,,False,,2024-01-03 08:00:00,2024-01-03\n"
)


@pytest.fixture
def warehouse(spark, folder):
    w = Warehouse(spark, folder)
    w.put_table("products", spark.createDataFrame(
        [(p, p, "c", "c", "c", D(4), "PZ", D("0.5"), D(1), None) for p in ("P1", "P2", "P3")],
        csv_files.schemas.TABLES["products"]))
    w.put_table("suppliers", spark.createDataFrame([("S1", "One", "primary")], csv_files.schemas.TABLES["suppliers"]))
    w.put_table("store_assortment", spark.createDataFrame(
        [(1, "P1", 7, 1, "left", 1, True), (1, "P3", 8, 1, "left", 1, None)],
        csv_files.schemas.TABLES["store_assortment"]))
    w.set_inventory(spark.createDataFrame([(1, "P1", 10), (1, "P3", 1)], "store_id int, product_id string, stock_qty int"))
    return w


def stock(w):
    return {r.product_id: r.stock_qty for r in w.inventory().collect()}


def fact(w):
    return sorted((r.product_id, r.movement_type, r.quantity, r.shelf_id) for r in w.movements().collect())


EXPECTED_STOCK = {"P1": 5, "P3": -4}
EXPECTED_FACT = sorted([
    ("P1", "sale", 2, 7), ("P1", "sale", 2, 7), ("P3", "purchase", 4, None), ("P1", "breakage", 1, 7),
    ("P3", "sale", 9, None),
])


def test_batch_of_all_days(warehouse, drops):
    drops("movements_2024-01-01.csv", DAY1)
    source = drops("movements_2024-01-02.csv", DAY2)
    extract, transform, load = warehouse.run(source)
    assert (extract.files, extract.rows, transform.rows, load.rows) == (2, 7, 7, 5)
    assert fact(warehouse) == EXPECTED_FACT
    assert stock(warehouse) == EXPECTED_STOCK
    bad = {r.product_id: r.error_reason for r in warehouse.bad_movements().collect()}
    assert bad == {"P2": "missing_sale_price", "NOPE": "unknown_product"}
    raw = warehouse.raw_movements()
    assert raw.select("raw_movement_id").distinct().count() == 7
    first = raw.filter("is_promo").first()
    assert first.movement_timestamp == dt.datetime(2024, 1, 1, 9, 0, 0, 123456)
    assert raw.filter("supplier_id = 'NA' or promo_type = 'None'").isEmpty()
    assert warehouse.cleaned_movements().filter("loaded and loaded_at is not null").count() == 5
    runs = warehouse.runs.read()
    counts = {(r.pipeline_step, r.source_file_name): (r.status, r.rows_processed, r.rows_success, r.rows_failed)
              for r in runs.collect()}
    assert counts == {
        ("extract", "movements_2024-01-01.csv"): ("success", 4, 4, 0),
        ("extract", "movements_2024-01-02.csv"): ("success", 3, 3, 0),
        ("transform", "movements_2024-01-01.csv"): ("success", 4, 3, 1),
        ("transform", "movements_2024-01-02.csv"): ("success", 3, 2, 1),
        ("load", None): ("success", 5, 5, 0),
    }
    assert runs.select("run_id").distinct().count() == 5
    tables = warehouse.tables()
    assert audit_unique(tables.replaced(suppliers=warehouse._master("suppliers"))).isEmpty()
    assert daily_kpis(tables).count() == 2
    # nothing new: no rows and no run rows
    again = warehouse.run(source)
    assert all(r.rows == 0 and r.files == 0 for r in again)
    assert stock(warehouse) == EXPECTED_STOCK and warehouse.runs.read().count() == 5


def test_day_by_day_equals_one_batch(warehouse, drops):
    warehouse.run(drops("movements_2024-01-01.csv", DAY1))
    assert stock(warehouse) == {"P1": 6, "P3": 5}
    warehouse.run(drops("movements_2024-01-02.csv", DAY2))
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK
    ids = warehouse.raw_movements().agg(F.count_distinct("raw_movement_id"), F.count("*")).first()
    assert ids[0] == ids[1] == 7


def test_broken_and_empty_files(warehouse, drops):
    drops("movements_2024-01-01.csv", DAY1)
    drops("movements_2024-01-03.csv", BROKEN)
    drops("movements_2024-01-04.csv", HEADER)
    source = drops("movements_2024-01-05.csv", "")
    result = warehouse.extract(source)
    assert (result.rows, result.failed_files) == (4, 2)
    assert warehouse.raw_movements().select("source_file_name").distinct().count() == 1
    done = {r.file_name for r in warehouse.processed_files().collect()}
    assert done == {"movements_2024-01-01.csv", "movements_2024-01-04.csv"}
    failed = {r.source_file_name: r.error_message for r in warehouse.runs.read().filter("status = 'failed'").collect()}
    assert set(failed) == {"movements_2024-01-03.csv", "movements_2024-01-05.csv"}
    assert warehouse.transform().rows == 4
    # the repaired file is taken by the next run
    drops("movements_2024-01-03.csv", BROKEN.replace("gift", "sale"))
    assert warehouse.extract(source).rows == 2


def test_columns_are_read_by_name_and_other_layouts_rejected_alone(warehouse, drops):
    drops("movements_2024-01-01.csv", DAY1)
    lines = [line.split(",") for line in DAY2.strip().split("\n")]
    swapped = "\n".join(",".join([r[1], r[0], *r[2:]]) for r in lines) + "\n"
    drops("movements_2024-01-06.csv", swapped)
    drops("movements_2024-01-07.csv", DAY2.replace("2024-01-02 08:00:00,2024-01-02", "2024-01-02 08:00:00,2024-01-02,x"))
    drops("movements_2024-01-09.csv", DAY2.replace("product_id", "article"))
    source = drops("movements_2024-01-08.csv", DAY2.replace("breakage,1", "breakage,1.5"))
    result = warehouse.extract(source)
    assert (result.files, result.rows, result.failed_files) == (5, 7, 3)
    again = warehouse.raw_movements().filter("source_file_name = 'movements_2024-01-06.csv'").collect()
    assert sorted((r.store_id, r.product_id) for r in again) == [(1, "NOPE"), (1, "P1"), (1, "P3")]
    assert warehouse.raw_movements().select("raw_movement_id").distinct().count() == 7


NAMES = [
    "movements 2024.csv", "movements%203.csv", "a+b.csv", "a=5.csv", "b=5.csv", "caffè.csv", "sub/x.csv", "x.csv", "q[1].csv",
]


def test_every_name_is_loaded_once(spark, warehouse, drops, tmp_path):
    (tmp_path / drops.folder / "sub").mkdir()
    for name in NAMES:
        source = drops(name, DAY1)
    drops("_hidden.csv", DAY1)
    result = warehouse.extract(source)
    assert (result.files, result.rows, result.failed_files) == (len(NAMES) + 1, 4 * len(NAMES), 1)
    counts = warehouse.raw_movements().groupBy("source_file_name").count().collect()
    assert {r.source_file_name: r["count"] for r in counts} == {n: 4 for n in NAMES}
    assert {r.file_name for r in warehouse.processed_files().collect()} == set(NAMES)
    assert [r.file_name for r in csv_files.source_files(spark, source).collect()] == sorted(NAMES)
    again = warehouse.extract(source)
    assert (again.rows, again.failed_files) == (0, 1)
    failed = warehouse.runs.read().filter("status = 'failed'").collect()
    assert {r.source_file_name for r in failed} == {"_hidden.csv"}


def test_wrong_bytes_reject_their_file_alone(warehouse, drops, tmp_path):
    source = drops("movements_2024-01-01.csv", DAY1)
    (tmp_path / source / "movements_2024-01-02.csv").write_bytes(DAY2.replace("NOPE", "caff\xe8").encode("latin-1"))
    result = warehouse.extract(source)
    assert (result.files, result.rows, result.failed_files) == (2, 4, 1)


def test_quotes_separators_and_line_breaks_survive(spark, folder):
    from storespark.sources.writers import write_csv

    italian = {new: old for old, new in csv_files.schemas.PRODUCT_MASTER_COLUMNS.items()}
    odd = 'TUBO 5"" PASTA; LUNGA,\nfresca\\'
    rows = [("P1", odd, "c", "c", "c", D(4), "PZ", D("0.5"), D("1.5"), '"B"')]
    products = spark.createDataFrame(rows, csv_files.schemas.TABLES["products"])
    write_csv(products.withColumnsRenamed(italian), f"{folder}/master")
    assert csv_files.products_master(spark, f"{folder}/master").collect() == products.collect()


def test_a_killed_step_leaves_a_running_row(warehouse, drops, monkeypatch):
    source = drops("movements_2024-01-01.csv", DAY1)

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(Warehouse, "_write", killed)
    with pytest.raises(KeyboardInterrupt):
        warehouse.extract(source)
    assert [r.status for r in warehouse.runs.read().collect()] == ["running"]


def test_stock_follows_commit_order_and_keeps_two_snapshots(warehouse, drops, spark):
    warehouse.run(drops("movements_2024-01-01.csv", DAY1))
    warehouse.run(drops("movements_2024-01-02.csv", DAY2))
    assert stock(warehouse) == EXPECTED_STOCK
    kept = spark.read.parquet(warehouse.path("inventory")).select("attempt_id").distinct().count()
    assert kept == pipeline.KEPT_SNAPSHOTS


def test_a_batch_before_the_stream_is_not_loaded_again(spark, warehouse, drops):
    drops("movements_2024-01-01.csv", DAY1)
    source = drops("movements_2024-01-02.csv", DAY2)
    warehouse.run(source)
    drops("movements_2024-01-04.csv", HEADER)
    for _ in range(2):  # each time a new checkpoint
        stream_pipeline(warehouse, source, shared_folder(spark, "stream")).awaitTermination()
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK
    assert warehouse.processed_files().filter("file_name = 'movements_2024-01-04.csv'").count() == 1


@pytest.mark.parametrize("step", ["extract", "transform", "load"])
def test_a_step_that_dies_before_its_commit_adds_nothing(warehouse, drops, monkeypatch, step):
    source = drops("movements_2024-01-01.csv", DAY1)
    drops("movements_2024-01-02.csv", DAY2)
    real = Warehouse.commit

    def dying(self, name, *args, **kwargs):
        if name == step:
            raise RuntimeError("executor lost")
        return real(self, name, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "commit", dying)
    if step == "load":
        with pytest.raises(RuntimeError):
            warehouse.run(source)
    else:
        warehouse.run(source)
    assert warehouse.runs.read().filter("status = 'failed'").count() >= 1
    assert stock(warehouse) == {"P1": 10, "P3": 1}
    monkeypatch.setattr(Warehouse, "commit", real)
    warehouse.run(source)
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK
    assert warehouse.raw_movements().count() == 7


def test_rows_are_gathered_when_lookups_are_too_big(warehouse, drops, monkeypatch):
    from storespark.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    drops("movements_2024-01-01.csv", DAY1)
    warehouse.run(drops("movements_2024-01-02.csv", DAY2))
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK


def test_a_drop_may_be_a_folder_of_parts(spark, drops, tmp_path):
    source = drops("movements_2024-01-01.csv", DAY1)
    part = tmp_path / source / "drop=movements_2024-01-02.csv"
    part.mkdir()
    (part / "part-0.csv").write_text(DAY2)
    (part / "part-1.csv").write_text(HEADER)
    names = [r.file_name for r in csv_files.source_files(spark, source).collect()]
    assert names == ["movements_2024-01-01.csv", "movements_2024-01-02.csv"]
    counts = csv_files.raw_ingest(spark, source).groupBy("source_file_name").count().collect()
    assert {r.source_file_name: r["count"] for r in counts} == {names[0]: 4, names[1]: 3}


def test_stream_equals_batch(spark, warehouse, drops):
    drops("movements_2024-01-01.csv", DAY1)
    source = drops("movements_2024-01-02.csv", DAY2)
    checkpoint = shared_folder(spark, "stream")
    stream_pipeline(warehouse, source, checkpoint, max_files=1).awaitTermination()
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK
    # same checkpoint, no new file: nothing happens
    commits = warehouse.commits().count()
    stream_pipeline(warehouse, source, checkpoint, max_files=1).awaitTermination()
    assert warehouse.commits().count() == commits


def test_a_rejected_first_file_keeps_no_other_back(spark, warehouse, drops):
    drops("a.csv", DAY1.replace("sale", "gift"))
    drops("movements_2024-01-01.csv", DAY1)
    source = drops("movements_2024-01-02.csv", DAY2)
    stream_pipeline(warehouse, source, shared_folder(spark, "stream"), max_files=1).awaitTermination()
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK
    assert {r.file_name for r in warehouse.ledger().collect()} == {"movements_2024-01-01.csv", "movements_2024-01-02.csv"}


def test_replayed_epoch_adds_nothing(spark, folder, drops):
    from storespark.streaming import ingest

    w = Warehouse(spark, folder)
    source = drops("movements_2024-01-01.csv", DAY1)
    stream_ingest(w, source, shared_folder(spark, "stream")).awaitTermination()
    ingest._extract_epoch(w, source, None)
    assert w.raw_movements().count() == 4


def test_ids_go_on_from_the_last_batch(spark, warehouse, drops):
    """Twenty thousand batches, and ids far above 2^49, are nothing special."""
    warehouse.commit("extract", [20_000], "faked", last_id=2**60)
    warehouse.extract(drops("movements_2024-01-01.csv", DAY1))
    assert warehouse.raw_movements().agg(F.min("raw_movement_id")).first()[0] > 2**60
    assert warehouse.commits().agg(F.max("batch_id")).first()[0] == 20_001
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        spark.range(0, 4, 1, 2).select(pipeline.row_id(2**63 - 2)).collect()
