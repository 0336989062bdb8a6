"""The nine analytic views.

Calendar columns depend on the date alone, so they are added after grouping.
Product and position columns are functions of (store, product): grouping goes
by the movement's own keys first wherever the result allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.functions.calendar import with_calendar
from storespark.functions.money import MONEY, fill_pct, line_value, margin_pct, money_sum, money_sum0
from storespark.operators.joins import (
    active_positions,
    attach,
    attach_named,
    attach_placed,
    layout_left_assortment,
    position_join,
    stock_join,
    tasks_for,
)
from storespark.operators.rollup import Lookup, additive, collapsed, summed_by
from storespark.tables import Tables

SHELF_DAY = ["store_id", "shelf_id", "movement_date"]
STORE_PRODUCT = ("store_id", "product_id")


def of_type(movements: DataFrame, kind: str) -> DataFrame:
    return movements.filter(F.col("movement_type") == kind)


def _sale_value() -> Column:
    return line_value(F.col("unit_sale_price"))


def _positions(t: Tables, *columns: str) -> Lookup:
    return Lookup(active_positions(t.store_assortment, list(columns)), STORE_PRODUCT)


def _costs(t: Tables) -> Lookup:
    return Lookup(t.products.select("product_id", "purchase_price"), ("product_id",))


def _cost() -> Column:
    return line_value(F.col("purchase_price"), F.col("qty"))


def _by_shelf(df: DataFrame, *measures: str) -> DataFrame:
    return with_calendar(df).select(*SHELF_DAY, "month", "year", "week", *measures)


def sales_by_shelf_historical(t: Tables) -> DataFrame:
    """Sales per shelf the product stood on when the movement was loaded."""
    sales = of_type(t.movements, "sale").filter(F.col("shelf_id").isNotNull())
    grouped = sales.groupBy(*SHELF_DAY).agg(
        F.count("*").alias("transaction_count"),
        F.sum("quantity").alias("qty_sold"),
        money_sum(_sale_value()).alias("revenue"),
    )
    return _by_shelf(grouped, "transaction_count", "qty_sold", "revenue")


def sales_by_shelf_current(t: Tables, collapse: bool | None = None) -> DataFrame:
    """Sales per shelf the product stands on now."""
    keys = ["store_id", "product_id", "movement_date"]
    grouped = summed_by(
        additive(of_type(t.movements, "sale"), keys, sales=_sale_value()),
        keys,
        [_positions(t, "shelf_id")],
        SHELF_DAY,
        {"transaction_count": F.sum("n"), "qty_sold": F.sum("qty"), "revenue": money_sum(F.col("sales"))},
        collapse,
    )
    return _by_shelf(grouped, "transaction_count", "qty_sold", "revenue")


def _breakage(t: Tables, facts: DataFrame, keys: list[str], lookups: list[Lookup], collapse: bool | None) -> DataFrame:
    sums = {"breakage_events": F.sum("n"), "qty_lost": F.sum("qty"), "breakage_cost": money_sum(_cost())}
    grouped = summed_by(facts, keys, [_costs(t), *lookups], SHELF_DAY, sums, collapse)
    return _by_shelf(grouped, "breakage_events", "qty_lost", "breakage_cost")


def breakage_by_shelf_historical(t: Tables, collapse: bool | None = None) -> DataFrame:
    """Breakage per shelf at load, valued at the product's purchase price."""
    broken = of_type(t.movements, "breakage").filter(F.col("shelf_id").isNotNull())
    keys = ["store_id", "product_id", "shelf_id", "movement_date"]
    return _breakage(t, additive(broken, keys), keys, [], collapse)


def breakage_by_shelf_current(t: Tables, collapse: bool | None = None) -> DataFrame:
    keys = ["store_id", "product_id", "movement_date"]
    broken = additive(of_type(t.movements, "breakage"), keys)
    return _breakage(t, broken, keys, [_positions(t, "shelf_id")], collapse)


def margins_by_product_shelf(t: Tables) -> DataFrame:
    """Margin per product, shelf at load (null is a group of its own) and day.

    The grain is the movement's own key, so movements are summed first and the
    product and brand columns joined to the result.
    """
    keys = ["store_id", "product_id", "shelf_id", "movement_date"]
    sums = collapsed(additive(of_type(t.movements, "sale"), keys, revenue=_sale_value()), keys)
    products = t.products.select(
        "product_id", "product_description", "category_level_1", "category_level_2", "brand_code", "purchase_price"
    )
    priced = attach_named(sums, products, t.brands).withColumns(
        {"revenue": F.col("revenue").cast(MONEY), "cost": _cost().cast(MONEY)}
    )
    return with_calendar(priced).select(
        "store_id", "product_id", "product_description", "category_level_1", "category_level_2",
        "brand_code", "brand_name", "shelf_id", "movement_date", "month", "year", "week",
        F.col("qty").alias("qty_sold"),
        "revenue",
        "cost",
        (F.col("revenue") - F.col("cost")).cast(MONEY).alias("margin"),
        margin_pct(F.col("revenue"), F.col("cost")).alias("margin_pct"),
    )


def daily_kpis(t: Tables, collapse: bool | None = None) -> DataFrame:
    """Eleven measures per store and day, over movements of known products.

    Rows are summed per movement type first, each with the one price its type
    has; the columns per type are then picked from three rows per store and day.
    """
    kind = F.col("movement_type")
    value = F.when(kind == "sale", _sale_value()).when(kind == "purchase", line_value(F.col("unit_purchase_price")))
    keys = ["store_id", "product_id", "movement_date", "movement_type"]
    per_type = summed_by(
        additive(t.movements, keys, value=value),
        keys,
        [_costs(t)],
        ["store_id", "movement_date", "movement_type"],
        {
            "n": F.sum("n"),
            "qty": F.sum("qty"),
            "value": F.sum("value"),
            "cost": F.sum(F.when(kind != "purchase", _cost())),
        },
        collapse,
    )

    def whole(of: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(kind == of, F.col(column))), F.lit(0))

    def amount(of: str, column: str) -> Column:
        return money_sum0(F.when(kind == of, F.col(column)))

    measures = {
        "sale_transactions": whole("sale", "n"),
        "qty_sold": whole("sale", "qty"),
        "revenue": amount("sale", "value"),
        "cogs": amount("sale", "cost"),
        "breakage_events": whole("breakage", "n"),
        "qty_breakage": whole("breakage", "qty"),
        "breakage_cost": amount("breakage", "cost"),
        "purchase_transactions": whole("purchase", "n"),
        "qty_purchased": whole("purchase", "qty"),
        "purchase_cost": amount("purchase", "value"),
        "total_movements": F.sum("n"),
    }
    grouped = per_type.groupBy("store_id", "movement_date").agg(*[m.alias(name) for name, m in measures.items()])
    return with_calendar(grouped).select("store_id", "movement_date", "month", "year", "week", *measures)


def inventory_by_shelf(t: Tables) -> DataFrame:
    """One row per active position: stock, capacity and fill."""
    products = t.products.select("product_id", "product_description", "category_level_1")
    positions, layout = active_positions(t.store_assortment), t.store_layout.drop("shelf_category")
    tasks = tasks_for(positions, t.inventory, layout, products)
    placed = stock_join(positions, t.inventory, tasks)
    named = attach(placed, products, ["product_id"], tasks=tasks)
    slots = position_join(named, layout, tasks)
    return slots.select(
        "store_id", "shelf_id", "shelf_level", "zone", "slot_number", "product_id", "product_description",
        "category_level_1", "stock_qty", "capacity", fill_pct(F.col("stock_qty"), F.col("capacity")).alias("fill_pct"),
    )


def slot_tasks(t: Tables) -> int:
    """Tasks for the joins of slots, positions and products."""
    products = t.products.select("product_id", "product_description", "category_level_1")
    return tasks_for(t.store_layout, t.store_assortment, products)


def shelf_detail(t: Tables, tasks: int | None = None) -> DataFrame:
    """One row per slot, empty ones included, with product, category and brand.

    Positions are named before they meet the slots: empty slots have no product, and would all go to one task.
    """
    tasks = slot_tasks(t) if tasks is None else tasks
    products = t.products.select(
        "product_id", "product_description", "category_level_1", "category_level_2", "brand_code"
    )
    named = attach_named(t.store_assortment, products, t.brands, "left", tasks)
    slots = layout_left_assortment(t.store_layout, named, tasks)
    return slots.select(
        "store_id", "shelf_id", "shelf_category", "shelf_level", "zone", "slot_number", "capacity", "product_id",
        "active_flag", "product_description", "category_level_1", "category_level_2", "brand_code", "brand_name",
    )


def shelf_movements_current(t: Tables) -> DataFrame:
    """Movements at the product's current position, not aggregated."""
    products = t.products.select(
        "product_id", "product_description", "category_level_1", "category_level_2", "brand_code",
        F.col("purchase_price").alias("unit_cost"),
    )
    moves = t.movements.drop("shelf_id", "shelf_level", "zone", "slot_number")
    rows = attach_placed(moves, t.store_assortment, products, t.brands)
    return with_calendar(rows).select(
        "store_id", "shelf_id", "shelf_level", "zone", "slot_number", "product_id", "product_description",
        "category_level_1", "category_level_2", "brand_code", "brand_name", "movement_type", "quantity",
        "unit_sale_price", "unit_purchase_price", "unit_cost", "is_promo", "movement_date", "month", "year", "week",
    )


VIEWS = {
    f.__name__: f
    for f in [
        sales_by_shelf_historical, sales_by_shelf_current, breakage_by_shelf_historical, breakage_by_shelf_current,
        margins_by_product_shelf, daily_kpis, inventory_by_shelf, shelf_detail, shelf_movements_current,
    ]
}


def register_views(t: Tables) -> None:
    """Make every view available to ``spark.sql`` under its name."""
    for name, view in VIEWS.items():
        view(t).createOrReplaceTempView(name)
