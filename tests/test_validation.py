from itertools import combinations

import pytest
from pyspark.sql import functions as F

from storespark.operators import validation
from storespark.operators.stock import inventory_apply, mark_loaded, net_stock_delta, opening_stock

DDL = (
    "raw_movement_id bigint, source_file_name string, store_id int, product_id string, supplier_id string, "
    "movement_type string, quantity int, unit_sale_price decimal(12,4), unit_purchase_price decimal(12,4)"
)
D = __import__("decimal").Decimal


def row(n, product="P1", supplier=None, kind="sale", sale=None, purchase=None):
    return (n, "f.csv", 1, product, supplier, kind, 1, sale, purchase)


@pytest.fixture(scope="module")
def masters(spark):
    products = spark.createDataFrame([("P1",), ("P2",)], "product_id string")
    suppliers = spark.createDataFrame([("S1",)], "supplier_id string")
    return products, suppliers


def reasons(spark, masters, rows):
    checked = validation.validate(spark.createDataFrame(rows, DDL), *masters)
    return {r.raw_movement_id: r.error_reason for r in checked.collect()}


def test_one_row_per_rule(spark, masters):
    rows = [
        row(1, sale=D("2")),
        row(2, product="X", sale=D("2")),
        row(3, supplier="S9", sale=D("2")),
        row(4, sale=None),
        row(5, sale=D("0")),
        row(6, sale=D("-1")),
        row(7, kind="purchase", supplier="S1"),
        row(8, kind="purchase", supplier="S1", purchase=D("0")),
        row(9, kind="breakage", sale=D("1")),
        row(10, kind="breakage", purchase=D("1")),
        row(11, kind="purchase", purchase=D("1")),
        row(12, product=None, sale=D("2")),
        row(13, kind=None, sale=D("0")),
        row(14, supplier="S1", sale=D("2")),
        row(15, kind="breakage"),
        row(16, kind="purchase", supplier="S1", purchase=D("3")),
    ]
    assert reasons(spark, masters, rows) == {
        1: None, 2: "unknown_product", 3: "unknown_supplier", 4: "missing_sale_price", 5: "missing_sale_price",
        6: "missing_sale_price", 7: "missing_purchase_price", 8: "missing_purchase_price", 9: "breakage_with_price",
        10: "breakage_with_price", 11: "purchase_without_supplier", 12: "unknown_product", 13: None, 14: None,
        15: None, 16: None,
    }


def test_first_rule_wins_for_each_pair(spark, masters):
    """Rows that break two rules carry the earlier one."""
    breakers = {
        ("unknown_product", "unknown_supplier"): row(0, product="X", supplier="S9", sale=D("1")),
        ("unknown_product", "missing_sale_price"): row(0, product="X"),
        ("unknown_product", "missing_purchase_price"): row(0, product="X", supplier="S1", kind="purchase"),
        ("unknown_product", "breakage_with_price"): row(0, product="X", kind="breakage", sale=D("1")),
        ("unknown_product", "purchase_without_supplier"): row(0, product="X", kind="purchase", purchase=D("1")),
        ("unknown_supplier", "missing_sale_price"): row(0, supplier="S9"),
        ("unknown_supplier", "missing_purchase_price"): row(0, supplier="S9", kind="purchase"),
        ("unknown_supplier", "breakage_with_price"): row(0, supplier="S9", kind="breakage", sale=D("1")),
        ("missing_purchase_price", "purchase_without_supplier"): row(0, kind="purchase"),
    }
    order = list(validation.rule_conditions())
    pairs = [p for p in combinations(order, 2) if p in breakers]
    rows = [(n, *breakers[p][1:]) for n, p in enumerate(pairs)]
    found = reasons(spark, masters, rows)
    assert [found[n] for n in range(len(pairs))] == [p[0] for p in pairs]
    assert len(pairs) == len(breakers)


def test_raw_is_clean_plus_bad_and_counts(spark, masters):
    rows = [row(n, product="P1" if n % 3 else "X", sale=D("1")) for n in range(30)]
    raw = spark.createDataFrame(rows, DDL)
    checked = validation.validate(raw, *masters)
    clean, bad = validation.clean_rows(checked), validation.bad_rows(checked)
    assert (clean.count(), bad.count()) == (20, 10)
    assert validation.validation_counts(checked).first()[1:] == (30, 20, 10)
    assert bad.select("error_details").distinct().first()[0] == "product_id not found in core.products"


def test_duplicate_master_rows_do_not_multiply(spark, masters):
    products = masters[0].union(masters[0])
    checked = validation.validate(spark.createDataFrame([row(1, sale=D("1"))], DDL), products, masters[1])
    assert checked.count() == 1


# ---- stock ------------------------------------------------------------------------------------


def stock_table(spark, rows):
    return spark.createDataFrame(rows, "store_id int, product_id string, stock_qty int, updated_at timestamp")


def test_stock_changes(spark):
    import datetime as dt

    old, now = dt.datetime(2024, 1, 1), F.lit("2024-02-01").cast("timestamp")
    inventory = stock_table(spark, [(1, "A", 5, old), (1, "B", 1, old), (1, "C", 7, old), (1, "D", 4, old)])
    moves = spark.createDataFrame(
        [(1, "A", "purchase", 3), (1, "A", "sale", 1), (1, "B", "breakage", 4), (1, "D", "sale", 2),
         (1, "D", "purchase", 2), (1, "Z", "sale", 9)],
        "store_id int, product_id string, movement_type string, quantity int",
    )
    after = inventory_apply(inventory, net_stock_delta(moves), now)
    got = {r.product_id: (r.stock_qty, r.updated_at != old) for r in after.collect()}
    # B goes negative, C is untouched, D nets to zero and is still touched, Z has no inventory
    assert got == {"A": (7, True), "B": (-3, True), "C": (7, False), "D": (4, True)}
    assert after.schema == inventory.schema


def test_mark_loaded_keeps_earlier_marks(spark):
    cleaned = spark.createDataFrame(
        [(1, False, None), (2, True, None), (3, False, None)],
        "cleaned_movement_id bigint, loaded boolean, loaded_at timestamp",
    )
    marked = mark_loaded(cleaned, cleaned.filter("cleaned_movement_id = 1"))
    got = {r.cleaned_movement_id: (r.loaded, r.loaded_at is not None) for r in marked.collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (False, False)}


def test_opening_stock(spark):
    specs = spark.createDataFrame(
        [("A", 5, True), ("B", 6, False), ("C", 7, None)], "product_id string, initial_stock int, assortment_flag boolean"
    )
    assert {tuple(r) for r in opening_stock(specs).collect()} == {(1, "A", 5), (1, "B", 0), (1, "C", 0)}
