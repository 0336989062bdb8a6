import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from storespark.operators import joins
from storespark.plans import dashboards, views
from storespark.tables import Tables
from storespark.testbed.adapters import Testbed

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bed(spark):
    return Testbed(spark, SF_DIR).tables()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", [
    "sales_by_shelf_current", "breakage_by_shelf_historical", "breakage_by_shelf_current", "daily_kpis",
])
def test_summing_first_gives_the_same(bed, name):
    view = views.VIEWS[name]
    assert rows(view(bed, collapse=True)) == rows(view(bed, collapse=False))


def test_views_equal_when_lookups_are_too_big_to_broadcast(spark, bed, monkeypatch):
    expected = {n: rows(v(bed)) for n, v in views.VIEWS.items()}
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, view in views.VIEWS.items():
            frame = view(bed)
            if name != "sales_by_shelf_historical":
                assert "SortMergeJoin" in frame._jdf.queryExecution().executedPlan().toString()
            assert rows(frame) == expected[name], name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_historical_equals_current_when_nothing_moved(bed):
    t = bed.replaced(movements=joins.enrich_shelf_position(
        bed.movements.drop(*joins.POSITION_KEY[1:]), bed.store_assortment))
    assert rows(views.sales_by_shelf_historical(t)) == rows(views.sales_by_shelf_current(t))
    assert rows(views.breakage_by_shelf_historical(t)) == rows(views.breakage_by_shelf_current(t))


def test_margin_and_kpis_agree(bed):
    margins = views.margins_by_product_shelf(bed)
    assert margins.filter("margin <> revenue - cost").isEmpty()
    summed = margins.agg(F.sum("revenue"), F.sum("cost"), F.sum("qty_sold")).first()
    kpis = views.daily_kpis(bed).agg(F.sum("revenue"), F.sum("cogs"), F.sum("qty_sold")).first()
    assert tuple(summed) == tuple(kpis)


def hand_made(spark):
    """A few movements with the edge cases of calendar, rounding and capacity."""
    products = spark.createDataFrame(
        [("A", "a", "c1", "c2", D("87.6600"), "B1"), ("B", "b", None, None, None, None), ("C", "c", "c1", None, D("1"), "B9")],
        "product_id string, product_description string, category_level_1 string, category_level_2 string, "
        "purchase_price decimal(12,4), brand_code string",
    )
    day = dt.date
    moves = spark.createDataFrame(
        [
            (1, "A", 1, "sale", 1, D("100"), None, False, day(2024, 2, 29)),
            (1, "A", 1, "sale", 1, D("100"), None, False, day(2024, 2, 29)),
            (1, "A", None, "sale", 2, D("0"), None, False, day(2024, 12, 30)),
            (1, "B", 2, "sale", 1, D("5"), None, False, day(2027, 1, 1)),
            (1, "C", 2, "sale", 8, D("1"), None, True, day(2027, 1, 1)),
            (1, "C", 2, "sale", 1, None, None, True, day(2027, 1, 2)),
            (1, "X", 2, "sale", 1, D("3"), None, False, day(2027, 1, 1)),
        ],
        "store_id int, product_id string, shelf_id int, movement_type string, quantity int, "
        "unit_sale_price decimal(12,4), unit_purchase_price decimal(12,4), is_promo boolean, movement_date date",
    )
    moves = moves.withColumns({"shelf_level": F.lit(1), "zone": F.lit("left"), "slot_number": F.lit(1)})
    brands = spark.createDataFrame([("B1", "Uno")], "brand_code string, brand_name string")
    position = "store_id int, product_id string, shelf_id int, shelf_level int, zone string, slot_number int"
    assortment = spark.createDataFrame(
        [(1, "A", 1, 1, "left", 1, True), (1, "B", 1, 1, "left", 2, None), (1, "C", 1, 1, "left", 3, False)],
        position + ", active_flag boolean",
    )
    layout = spark.createDataFrame(
        [(1, 1, 1, "left", n, None, c) for n, c in ((1, 0), (2, None), (3, 3))] + [(1, 1, 1, "right", 1, "x", 1)],
        "store_id int, shelf_id int, shelf_level int, zone string, slot_number int, shelf_category string, capacity int",
    )
    inventory = spark.createDataFrame(
        [(1, "A", 2), (1, "B", 2), (1, "C", -2)], "store_id int, product_id string, stock_qty int"
    )
    return Tables({"products": products, "movements": moves, "brands": brands, "store_assortment": assortment,
                   "store_layout": layout, "inventory": inventory})


def test_calendar_and_rounding(spark):
    t = hand_made(spark)
    got = {(r.product_id, str(r.movement_date)): r for r in views.margins_by_product_shelf(t).collect()}
    assert ("X", "2027-01-01") not in got
    leap = got["A", "2024-02-29"]
    assert (leap.month, leap.year, leap.week, leap.qty_sold, leap.brand_name) == ("2024-02", 2024, 9, 2, "Uno")
    assert leap.margin_pct == D("12.34")
    assert (got["A", "2024-12-30"].year, got["A", "2024-12-30"].week) == (2024, 1)
    assert got["A", "2024-12-30"].margin_pct == 0 and got["A", "2024-12-30"].shelf_id is None
    assert (got["B", "2027-01-01"].year, got["B", "2027-01-01"].week) == (2027, 53)
    assert got["B", "2027-01-01"].cost is None and got["B", "2027-01-01"].margin_pct is None
    assert got["C", "2027-01-02"].revenue is None and got["C", "2027-01-02"].margin_pct is None


def test_division_is_rounded_once(spark):
    """A quotient of 12.3449999...: rounding twice would give 12.35."""
    from storespark.functions.money import MONEY, margin_pct

    pair = spark.createDataFrame([(D("100000.0000"), D("87655.0001"))], "r decimal(12,4), c decimal(12,4)")
    frame = pair.select(margin_pct(F.col("r").cast(MONEY), F.col("c").cast(MONEY)).alias("p"))
    assert frame.first().p == D("12.34")


def test_shelf_detail_keeps_empty_slots(spark):
    t = hand_made(spark)
    detail = views.shelf_detail(t)
    assert detail.count() == 4
    empty = detail.filter("zone = 'right'").first()
    assert empty.product_id is None and empty.brand_name is None
    fill = {r.product_id: r.fill_pct for r in views.inventory_by_shelf(t).collect()}
    assert fill == {"A": 0}


def test_fill_pct(spark):
    from storespark.functions.money import fill_pct

    frame = spark.createDataFrame([(2, 3), (2, 0), (2, None), (-2, 3), (1, 8)], "s int, c int")
    got = [r[0] for r in frame.select(fill_pct(F.col("s"), F.col("c"))).collect()]
    assert got == [D("66.7"), 0, None, D("-66.7"), D("12.5")]


def test_filters_reach_the_scan(spark, bed, folder):
    bed.movements.write.partitionBy("movement_date").parquet(folder)
    stored = bed.replaced(movements=spark.read.parquet(folder))
    frame = dashboards.overview_totals(stored, month="1998-03")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(movement_date" in plan and "movement_date#" in plan
    expected = dashboards.overview_trend(bed).filter("period = '1998-03'").first()
    assert frame.first().revenue == expected.revenue


def test_dashboard_filters(bed):
    sales = views.sales_by_shelf_historical(bed)
    got = dashboards.dashboard_filter(sales, year=1998, week=10, shelf_id=1)
    expected = sales.filter("year = 1998 and week = 10 and shelf_id = 1")
    assert rows(got) == rows(expected)
    day = sales.first().movement_date
    assert rows(dashboards.dashboard_filter(sales, day=day)) == rows(sales.filter(F.col("movement_date") == F.lit(day)))


def test_shares_add_up(bed):
    share = dashboards.share_of_shelf(bed).groupBy("store_id", "shelf_id").agg(F.sum("shelf_share_pct").alias("s"))
    assert share.filter("abs(s - 100) > 0.5").isEmpty()
    sales = dashboards.share_of_sales(bed, "category")
    total = sales.agg(F.sum("revenue")).first()[0]
    assert total == dashboards.shelf_mix_kpis(bed).agg(F.sum("revenue")).first()[0]


def test_views_can_be_registered(spark, bed):
    views.register_views(bed)
    assert spark.sql("select count(*) from daily_kpis").first()[0] == views.daily_kpis(bed).count()


def test_grid_shows_every_placed_product(bed):
    placed = joins.active_positions(bed.store_assortment).join(bed.products, "product_id").count()
    assert dashboards.shelf_products_grid(bed, day="1998-01-01").count() == placed


@pytest.mark.parametrize("table, filters", [
    (dashboards.overview_totals, {"shelf_id": 3}), (dashboards.overview_trend, {"shelf_id": 3}),
    (dashboards.share_of_shelf, {"month": "2024-01"}), (dashboards.shelf_mix_kpis, {"monht": "2024-01"}),
])
def test_a_filter_a_table_does_not_have_is_an_error(bed, table, filters):
    with pytest.raises(ValueError, match="not a filter"):
        table(bed, **filters)


@pytest.mark.parametrize("year, week", [(1996, 1), (1998, 53), (1999, 53), (1997, 1), (2000, 52)])
def test_week_with_year_is_a_range(bed, year, week):
    both = dashboards.dashboard_filter(bed.movements, year=year, week=week)
    apart = bed.movements.filter((F.year("movement_date") == year) & (F.weekofyear("movement_date") == week))
    assert rows(both) == rows(apart)
    assert "weekofyear" not in both._jdf.queryExecution().optimizedPlan().toString()
