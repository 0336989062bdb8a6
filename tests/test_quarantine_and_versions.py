"""Files that are left alone, epochs that list nothing, and stock versions per store."""

import os

import pytest
from pyspark.sql import functions as F

from storespark.operators.stock import inventory_apply
from storespark.plans.stock_versions import StockVersions
from storespark.session import shared_folder
from storespark.sources import csv_files
from storespark.streaming import ingest
from storespark.streaming.ingest import stream_pipeline
from test_pipeline import BROKEN, DAY1, DAY2, EXPECTED_FACT, EXPECTED_STOCK, fact, stock, warehouse  # noqa: F401


def unreadable(folder: str, name: str) -> None:
    """A file whose checksum does not match."""
    with open(os.path.join(folder, f".{name}.crc"), "wb") as out:
        out.write(b"crc\x00\x00\x00\x02\x00\x01\x02\x03\x04")


def stored_raw(w) -> int:
    return w._stored("raw_movements").count()


def test_rejected_files_are_stored_and_logged_once(warehouse, drops, tmp_path):  # noqa: F811
    drops("movements_2024-01-01.csv", DAY1)
    drops("bad.csv", BROKEN)
    drops("void.csv", "")
    (tmp_path / drops.folder / "sub" / "deep").mkdir(parents=True)
    (tmp_path / drops.folder / "_kept" / "sub").mkdir(parents=True)
    for name in ("_hid.csv", "sub/.hid.csv", "sub/deep/_hid.csv", "_kept/sub/x.csv"):
        source = drops(name, DAY2)
    drops("torn.csv", DAY2)
    unreadable(source, "torn.csv")
    results = [warehouse.extract(source) for _ in range(3)]
    assert [r.rows for r in results] == [4, 0, 0] and all(r.error is None for r in results)
    assert [r.failed_files for r in results] == [7, 4, 4]  # hidden names are told each time
    failed = [r.source_file_name for r in warehouse.runs.read().filter("status = 'failed' and source_file_name is not null").collect()]
    hidden = ["_hid.csv", "_kept/sub/x.csv", "sub/.hid.csv", "sub/deep/_hid.csv"]
    assert sorted(failed) == sorted([*hidden, "bad.csv", "torn.csv", "void.csv"])
    n = stored_raw(warehouse)
    quarantine = {r.file_name: (r.length, r.reason) for r in warehouse.quarantine().collect()}
    assert set(quarantine) == set(failed) and quarantine["void.csv"][0] == 0 and "break" in quarantine["bad.csv"][1]
    assert warehouse.extract(source).rows == 0 and stored_raw(warehouse) == n
    # a file that changes is tried again, by its length or by its time alone
    drops("bad.csv", BROKEN.replace("gift", "sale").replace(",2,,", ",20,,"))
    os.remove(os.path.join(source, ".torn.csv.crc"))
    os.utime(os.path.join(source, "torn.csv"), (2_000_000_000, 2_000_000_000))
    done = warehouse.extract(source)
    assert (done.rows, done.failed_files) == (5, 4)
    assert {r.file_name for r in warehouse.ledger().collect()} == {"movements_2024-01-01.csv", "bad.csv", "torn.csv"}


def test_a_drop_of_parts_is_tried_again_when_one_part_changes(warehouse, drops, tmp_path):  # noqa: F811
    source = drops("movements_2024-01-01.csv", DAY1)
    folder = tmp_path / source / "movements_2024-01-03.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text(BROKEN)
    (folder / "part-1.csv").write_text(DAY2)
    assert [warehouse.extract(source).failed_files for _ in range(2)] == [1, 0]
    (folder / "part-0.csv").write_text(BROKEN.replace("gift", "breakage").replace(",2,,", ",,,"))
    assert (warehouse.extract(source).rows, warehouse.ledger().count()) == (5, 2)


def test_an_unreadable_file_ends_neither_stream_nor_batch(spark, warehouse, drops):  # noqa: F811
    drops("a.csv", DAY1)
    unreadable(drops.folder, "a.csv")
    drops("movements_2024-01-01.csv", DAY1)
    source = drops("movements_2024-01-02.csv", DAY2)
    checkpoint = shared_folder(spark, "stream")
    for _ in range(2):
        stream_pipeline(warehouse, source, checkpoint, max_files=1).awaitTermination()
        assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK
    drops("movements_2024-01-05.csv", DAY1)
    stream_pipeline(warehouse, source, checkpoint, max_files=1).awaitTermination()
    assert warehouse.ledger().count() == 3
    assert {r.file_name for r in warehouse.quarantine().collect()} == {"a.csv"}


def test_later_epochs_list_no_folder_but_those_of_their_parts(spark, warehouse, drops, tmp_path, monkeypatch):  # noqa: F811
    folder = tmp_path / drops.folder / "b=movements_2024-01-02.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text(DAY2)
    source = drops("a.csv", DAY1)
    real, listed, epochs = csv_files.list_files, [], []

    def counted(spark, folder, paths=None):
        listed.append(paths)
        return real(spark, folder, paths)

    def late(warehouse, folder, most, files=None):
        """Files that come while the first epoch is under way."""
        epochs.append(sorted(r["file_name"] for r in files.collect()) if files is not None else None)
        return real_epoch(warehouse, folder, most, files)

    real_epoch = ingest._extract_epoch
    monkeypatch.setattr(csv_files, "list_files", counted)
    monkeypatch.setattr("storespark.plans.pipeline.list_files", counted)
    monkeypatch.setattr(ingest, "_extract_epoch", late)
    stream_pipeline(warehouse, source, shared_folder(spark, "stream"), max_files=1).awaitTermination()
    assert len(epochs) == 2 and epochs[0] is None and len(epochs[1]) == 1
    assert listed[0] is None and all(p for p in listed[1:])
    assert fact(warehouse) == EXPECTED_FACT and stock(warehouse) == EXPECTED_STOCK


def test_an_epoch_completes_drops_of_parts(spark, warehouse, drops, tmp_path):  # noqa: F811
    source = drops("x.csv", DAY1)
    folder = tmp_path / source / "y.csv"
    folder.mkdir()
    for part in range(3):
        (folder / f"part-{part}.csv").write_text(DAY2)
    files = csv_files.list_files(spark, source)
    own = files.where(F.col("path").endswith("part-1.csv"))
    ingest._extract_epoch(warehouse, source, None, own)
    assert warehouse.raw_movements().groupBy("source_file_name").count().collect() == [("y.csv", 9)]


@pytest.fixture
def versions(spark, folder):
    return StockVersions(spark, f"{folder}/inventory", f"{folder}/manifest")


def folders(path: str, attempt: str) -> set[str]:
    at = f"{path}/attempt_id={attempt}"
    return {d for d in os.listdir(at) if d.startswith("store_id")} if os.path.isdir(at) else set()


def test_a_load_writes_the_stores_it_touches(spark, versions):
    rows = [(s, f"P{p}", 10) for s in range(100) for p in range(3)]
    stock = spark.createDataFrame(rows, "store_id int, product_id string, stock_qty int").withColumn("updated_at", F.current_timestamp())
    versions.write(stock, "first")
    delta = spark.createDataFrame([(7, "P1", 5), (7, "P9", 1), (500, "P1", 3)], "store_id int, product_id string, net_qty bigint")
    versions.apply(delta, "first", "second")
    assert len(folders(versions.rows_path, "first")) == 100 and folders(versions.rows_path, "second") == {"store_id=7"}
    expected = inventory_apply(stock, delta).drop("updated_at").collect()
    assert sorted(versions.read("second").drop("updated_at").collect()) == sorted(expected)
    assert versions.manifest("second").count() == 100
    # the state before stays readable until it is expired, and goes store by store
    assert versions.read("first").agg(F.sum("stock_qty")).first()[0] == 3000
    versions.apply(spark.createDataFrame([(8, "P0", -2)], "store_id int, product_id string, net_qty bigint"), "second", "third")
    versions.expire(["third", "second", "first"])
    assert folders(versions.rows_path, "first") == {f"store_id={s}" for s in range(100) if s != 7}
    assert versions.read("third").agg(F.sum("stock_qty")).first()[0] == 3003 and versions.read("first").isEmpty()
    everywhere = spark.createDataFrame([(s, "P0", 1) for s in range(100)], "store_id int, product_id string, net_qty bigint")
    versions.apply(everywhere, "third", "fourth")
    versions.apply(everywhere, "fourth", "fifth")
    versions.expire(["fifth", "fourth", "third", "second"])
    assert not folders(versions.rows_path, "first") and len(folders(versions.rows_path, "fourth")) == 100
    assert versions.read("fifth").agg(F.sum("stock_qty")).first()[0] == 3203


def test_a_load_without_any_stock(spark, warehouse, drops, folder):  # noqa: F811
    from storespark.plans.pipeline import Warehouse

    bare = Warehouse(spark, f"{folder}/bare")
    for name in ("products", "suppliers", "store_assortment"):
        bare.put_table(name, warehouse._master(name))
    source = drops("movements_2024-01-02.csv", DAY2.replace("P1", "NO").replace("P3", "NO"))
    assert bare.run(source)[2].rows == 0  # no clean row, and no stock was ever set
    drops("movements_2024-01-01.csv", DAY1)
    assert bare.run(source)[2].rows == 3 and bare.inventory().isEmpty()


def test_a_quoted_cell_may_go_over_lines(warehouse, drops):  # noqa: F811
    lines = DAY1.replace("offerta_3x2", '"offerta\n3x2, ""due"""')
    drops("movements_2024-01-01.csv", lines)
    swapped = [line.split(",") for line in DAY2.strip().split("\n")]
    other = "\n".join(",".join([r[1], r[0], *r[2:]]) for r in swapped).replace("NOPE,1,,", 'NOPE,1,"S\n9",') + "\n"
    drops("movements_2024-01-02.csv", other)
    source = drops("open.csv", DAY1.replace("P3", '"P3'))
    result = warehouse.extract(source)
    assert (result.files, result.rows, result.failed_files) == (3, 7, 1)
    raw = warehouse.raw_movements()
    assert {r.promo_type for r in raw.where("is_promo").collect()} == {'offerta\n3x2, "due"'}
    assert raw.where("product_id = 'NOPE'").first().supplier_id == "S\n9"
    assert warehouse.extract(source).files == 0
