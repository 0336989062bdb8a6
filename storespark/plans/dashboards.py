"""Tables behind the two dashboards. They sum movements by store and product first and name things afterwards."""

from __future__ import annotations

import calendar
import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storespark.functions.money import MONEY, line_value, money_sum, money_sum0, percent, ratio
from storespark.operators.joins import active_positions, attach, attach_named, dealt, shuffled
from storespark.operators.rollup import additive, collapsed
from storespark.plans.views import daily_kpis, inventory_by_shelf, shelf_detail, slot_tasks
from storespark.tables import Tables

SHELF = ["store_id", "shelf_id"]


def dashboard_filter(
    df: DataFrame,
    shelf_id: int | None = None,
    month: str | None = None,
    year: int | None = None,
    week: int | None = None,
    day: dt.date | str | None = None,
) -> DataFrame:
    """Linked filters; each one given must hold.

    Year, month and day become ranges of ``movement_date``, and so does a week
    with a year, which prune date folders and Parquet row groups.
    """
    date = F.col("movement_date")
    if shelf_id is not None:
        df = df.filter(F.col("shelf_id") == shelf_id)
    if year is not None:
        df = df.filter(date.between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31))))
    if month is not None:
        y, m = map(int, month.split("-"))
        df = df.filter(date.between(F.lit(dt.date(y, m, 1)), F.lit(dt.date(y, m, calendar.monthrange(y, m)[1]))))
    if week is not None and year is not None:
        # an ISO week of the year before or after may lie in this calendar year
        spans = [_iso_week(y, week) for y in (year - 1, year, year + 1)]
        within = [date.between(F.lit(a), F.lit(b)) for a, b in filter(None, spans)]
        df = df.filter(reduce(Column.__or__, within))
    elif week is not None:
        df = df.filter(F.weekofyear(date) == week)
    if day is not None:
        df = df.filter(date == F.lit(str(day)).cast("date"))
    return df


def _iso_week(year: int, week: int) -> tuple[dt.date, dt.date] | None:
    """First and last day, none where the year has no such week."""
    try:
        return dt.date.fromisocalendar(year, week, 1), dt.date.fromisocalendar(year, week, 7)
    except ValueError:
        return None


DATES = ("month", "year", "week", "day")


def _supported(filters: dict, *names: str) -> dict:
    """The filters that are set; one that the table has no column for is an error."""
    given = {k: v for k, v in filters.items() if v is not None}
    if unknown := set(given) - set(names):
        raise ValueError(f"not a filter of this table: {', '.join(sorted(unknown))}; it has {', '.join(names)}")
    return given


def _filtered(t: Tables, filters: dict) -> Tables:
    """Filters on dates apply to movements, before anything is joined or summed."""
    dates = {k: v for k, v in filters.items() if k != "shelf_id"}
    return t.replaced(movements=dashboard_filter(t.movements, **dates)) if dates else t


def _on_shelf(df: DataFrame, filters: dict) -> DataFrame:
    shelf = filters.get("shelf_id")
    return df if shelf is None else df.filter(F.col("shelf_id") == shelf)


def overview_totals(t: Tables, **filters) -> DataFrame:
    """Revenue, quantity sold, breakage and margin over the filtered days."""
    filters = _supported(filters, *DATES)
    revenue, cogs = money_sum0(F.col("revenue")), money_sum0(F.col("cogs"))
    return daily_kpis(_filtered(t, filters)).agg(
        revenue.alias("revenue"),
        F.coalesce(F.sum("qty_sold"), F.lit(0)).alias("qty_sold"),
        F.coalesce(F.sum("qty_breakage"), F.lit(0)).alias("qty_breakage"),
        money_sum0(F.col("breakage_cost")).alias("breakage_cost"),
        (revenue - cogs).cast(MONEY).alias("margin"),
    )


_PERIODS = {
    "day": lambda: F.date_format("movement_date", "yyyy-MM-dd"),
    "week": lambda: F.format_string("%d-W%02d", "year", "week"),
    "month": lambda: F.col("month"),
}


def overview_trend(t: Tables, grain: str = "month", **filters) -> DataFrame:
    """Sales and cost, purchased and sold quantities, revenue / cost over days, weeks or months."""
    filters = _supported(filters, *DATES)
    by_period = daily_kpis(_filtered(t, filters)).groupBy(_PERIODS[grain]().alias("period")).agg(
        money_sum(F.col("revenue")).alias("revenue"),
        money_sum(F.col("cogs")).alias("cogs"),
        F.sum("qty_purchased").alias("qty_purchased"),
        F.sum("qty_sold").alias("qty_sold"),
    )
    return by_period.withColumn("revenue_cost_ratio", ratio(F.col("revenue"), F.col("cogs")))


def _product_sums(t: Tables) -> DataFrame:
    """Sold and broken quantity, revenue and cost per store and product.

    One row per key whatever the share of a product in all movements; the joins
    that follow never see single movements.
    """
    keys = ["store_id", "product_id"]
    sold, broken = F.col("movement_type") == "sale", F.col("movement_type") == "breakage"
    quantity = F.col("quantity").cast("bigint")
    moves = t.movements.filter(sold | broken)
    return collapsed(
        additive(
            moves,
            keys,
            sales=F.when(sold, line_value(F.col("unit_sale_price"))),
            sale_rows=F.when(sold, 1).otherwise(0).cast("bigint"),
            qty_sold=F.when(sold, quantity).otherwise(0),
            qty_breakage=F.when(broken, quantity).otherwise(0),
        ),
        keys,
    )


def _placed_sums(t: Tables, tasks: int) -> DataFrame:
    """Product sums at the current position with product and brand columns."""
    products = t.products.select(
        "product_id", "product_description", "category_level_1", "brand_code", "purchase_price"
    )
    placed = shuffled(_product_sums(t), active_positions(t.store_assortment), ["store_id", "product_id"], tasks=tasks)
    return attach_named(placed, products, t.brands, tasks=tasks)


def shelf_products_grid(t: Tables, **filters) -> DataFrame:
    """Every product that is placed, by shelf, level and zone, with its sold and broken quantity and its stock."""
    filters = _supported(filters, "shelf_id", *DATES)
    keys = ["store_id", "product_id"]
    tasks = slot_tasks(t)
    placed = _on_shelf(active_positions(t.store_assortment), filters)
    named = attach(placed, t.products.select("product_id", "product_description"), ["product_id"], tasks=tasks)
    sums = _product_sums(_filtered(t, filters)).select(*keys, "qty_sold", "qty_breakage")
    stock = inventory_by_shelf(t).select(*keys, "stock_qty")
    moved = shuffled(named, sums, keys, "left", tasks).fillna(0, ["qty_sold", "qty_breakage"])
    return shuffled(moved, stock, keys, "left", tasks).select(
        "store_id", "shelf_id", "shelf_level", "zone", "slot_number", "product_id", "product_description",
        "qty_sold", "qty_breakage", "stock_qty",
    )


def _revenue() -> Column:
    return money_sum0(F.col("sales"))


def _sale_cost() -> Column:
    return money_sum0(line_value(F.col("purchase_price"), F.col("qty_sold")))


def shelf_level_kpis(t: Tables, by_zone: bool = True, **filters) -> DataFrame:
    """Quantity, revenue, average price and margin of sales per level, and per zone where asked."""
    filters = _supported(filters, "shelf_id", *DATES)
    keys = [*SHELF, "shelf_level", *(["zone"] if by_zone else [])]
    tasks = slot_tasks(t)
    sums = _on_shelf(_placed_sums(_filtered(t, filters), tasks), filters).filter("sale_rows > 0")
    return sums.groupBy(*keys).agg(
        F.sum("qty_sold").alias("qty_sold"),
        _revenue().alias("revenue"),
        ratio(_revenue(), F.sum("qty_sold")).alias("avg_price"),
        (_revenue() - _sale_cost()).cast(MONEY).alias("margin"),
    )


_SHARE_COLUMNS = {"brand": "brand_code", "category": "category_level_1"}


def share_of_shelf(t: Tables, by: str = "brand", tasks: int | None = None, **filters) -> DataFrame:
    """Slots a brand or category holds, and its share of the occupied slots of the shelf."""
    filters = _supported(filters, "shelf_id")
    item = _SHARE_COLUMNS[by]
    tasks = slot_tasks(t) if tasks is None else tasks
    occupied = _on_shelf(shelf_detail(t, tasks), filters).filter(F.col("product_id").isNotNull())
    slots = dealt(occupied.select(*SHELF, item), SHELF, tasks).groupBy(*SHELF, item).agg(F.count("*").alias("slots"))
    # the window sees one row per brand or category of a shelf, at most one per slot
    whole = F.sum("slots").over(W.partitionBy(*SHELF))
    return slots.withColumn("shelf_share_pct", percent(F.col("slots"), whole))


def share_of_sales(t: Tables, by: str = "brand", **filters) -> DataFrame:
    """Revenue share of a brand or category on its shelf beside its share of the space.

    Space and sales of a shelf are dealt to one task, where they are grouped together; only what has space is kept.
    """
    filters = _supported(filters, "shelf_id", *DATES)
    item = _SHARE_COLUMNS[by]
    tasks = slot_tasks(t)
    sums = _on_shelf(_placed_sums(_filtered(t, filters), tasks), filters).select(*SHELF, item, "sales")
    space = share_of_shelf(t, by, tasks, shelf_id=filters.get("shelf_id"))
    both = dealt(space.unionByName(sums, allowMissingColumns=True), SHELF, tasks)
    joined = both.groupBy(*SHELF, item).agg(
        F.max("slots").alias("slots"), F.max("shelf_share_pct").alias("shelf_share_pct"), _revenue().alias("revenue")
    ).filter(F.col("slots").isNotNull())
    whole = F.sum("revenue").over(W.partitionBy(*SHELF))
    return joined.withColumn("sales_share_pct", percent(F.col("revenue"), whole))


def shelf_mix_kpis(t: Tables, **filters) -> DataFrame:
    """Distinct brands and categories on a shelf with its revenue and margin."""
    filters = _supported(filters, "shelf_id", *DATES)
    tasks = slot_tasks(t)
    occupied = _on_shelf(shelf_detail(t, tasks), filters).filter(F.col("product_id").isNotNull())
    mix = occupied.groupBy(*SHELF).agg(
        F.count_distinct("brand_code").alias("brands"), F.count_distinct("category_level_1").alias("categories")
    )
    sums = _on_shelf(_placed_sums(_filtered(t, filters), tasks), filters).groupBy(*SHELF).agg(
        _revenue().alias("_revenue"), (_revenue() - _sale_cost()).alias("_margin")
    )
    return shuffled(mix, sums, SHELF, "left", tasks=0).select(
        *SHELF, "brands", "categories",
        F.coalesce(F.col("_revenue"), F.lit(0)).cast(MONEY).alias("revenue"),
        F.coalesce(F.col("_margin"), F.lit(0)).cast(MONEY).alias("margin"),
    )
