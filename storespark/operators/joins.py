"""Joins of movements with lookup tables.

A lookup is broadcast only when the planner's size estimate and its counted
rows are inside a limit, and movements then stay where they are. Beyond it both
sides are shuffled by the key, once, and adaptive execution splits the
partitions of hot keys. The planner alone is not asked: it sees the bytes of
compressed files and one row for each one that is exploded, so that tables of
millions of rows look small to it.

Adaptive execution sees compressed bytes too, and would merge the partitions of
such tables until one task sorts millions of rows. Joins of tables with a row
per slot or product are dealt to a number of tasks that grows with the counted
rows, and are not merged.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: what a row and each of its columns take in a hash table, besides texts
_ROW_BYTES, _COLUMN_BYTES = 96, 16
#: what one task of a dealt join or group takes of the rows of its tables
TASK_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Planner estimate of the frame's size after pruning, None where no classic session backs it."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
    except AttributeError:
        return None
    return int(str(stats.sizeInBytes()))


def _held(df: DataFrame) -> DataFrame:
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    row = reduce(Column.__add__, texts, F.lit(_ROW_BYTES + _COLUMN_BYTES * len(df.columns)))
    return df.agg(F.sum(row.cast("bigint")).alias("held"))


def held_bytes(*frames: DataFrame) -> int:
    """What hash tables of the frames take, by their rows and the length of their texts; one job counts them."""
    return reduce(DataFrame.unionAll, map(_held, frames)).agg(F.sum("held")).first()[0] or 0


def tasks_for(*frames: DataFrame, times: int = 1) -> int:
    """Tasks to deal the rows of the frames to, each row ``times`` over; 0 where one task may take them all.

    The session's shuffle partitions where these are more, up to four times, so that sums by the same keys are not
    shuffled again.
    """
    needed = math.ceil(held_bytes(*frames) * times / TASK_BYTES)
    usual = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(needed, min(usual, 4 * needed)) if needed > 1 else 0


def dealt(df: DataFrame, on: list[str], tasks: int) -> DataFrame:
    """Rows dealt by their keys to so many tasks, which are not merged; 0 leaves them as they are."""
    return df.repartition(tasks, *on) if tasks else df


def fits_broadcast(*frames: DataFrame, limit: int | None = None) -> bool:
    """Whether the frames together are inside the limit, as estimated and then as counted; an unknown size is not."""
    limit = BROADCAST_LIMIT_BYTES if limit is None else limit
    sizes = [estimated_bytes(f) for f in frames]
    return None not in sizes and sum(sizes) <= limit and held_bytes(*frames) <= limit


def shuffled(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", tasks: int | None = None) -> DataFrame:
    """Join by a shuffle and a merge, which hold no side in memory, whatever the planner takes their sizes for.

    ``tasks`` is what ``tasks_for`` said of the tables behind both sides; without it both sides are counted. With 0
    the planner shuffles, and adaptive execution merges small partitions and splits those of hot keys.
    """
    tasks = tasks_for(left, right) if tasks is None else tasks
    return dealt(left, on, tasks).join(dealt(right, on, tasks).hint("merge"), on, how)


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    sized_by: tuple[DataFrame, ...] | None = None,
    small: bool | None = None,
    tasks: int = 0,
) -> DataFrame:
    """Join a lookup to facts, broadcasting it only below the size limit.

    ``sized_by`` names the frames that bound a lookup which is itself a join
    along a key; the planner would take the product of their sizes. ``small``
    tells what ``fits_broadcast`` said, where that was asked before. ``tasks``
    deals facts that hold a few rows of each key, as in ``shuffled``; movements
    are left to the planner, for their hot keys.
    """
    if fits_broadcast(*(sized_by or (lookup,))) if small is None else small:
        return facts.join(F.broadcast(lookup), on, how)
    return shuffled(facts, lookup, on, how, tasks)


def active_positions(assortment: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Positions in use; a null flag counts as not in use."""
    columns = columns or ["shelf_id", "shelf_level", "zone", "slot_number"]
    return assortment.filter("active_flag").select("store_id", "product_id", *columns)


def enrich_shelf_position(movements: DataFrame, assortment: DataFrame) -> DataFrame:
    """Add the position a product has now; rows without one keep null positions."""
    return attach(movements, active_positions(assortment), ["store_id", "product_id"], "left")


def movements_products(movements: DataFrame, products: DataFrame, *columns: str) -> DataFrame:
    """Movements of known products, with the named product columns."""
    return attach(movements, products.select("product_id", *columns), ["product_id"])


def movements_current_position(movements: DataFrame, assortment: DataFrame, *columns: str) -> DataFrame:
    return attach(movements, active_positions(assortment, list(columns) or None), ["store_id", "product_id"])


def brand_left_join(products: DataFrame, brands: DataFrame) -> DataFrame:
    return attach(products, brands.select("brand_code", "brand_name"), ["brand_code"], "left")


POSITION_KEY = ["store_id", "shelf_id", "shelf_level", "zone", "slot_number"]


def position_join(assortment: DataFrame, layout: DataFrame, tasks: int | None = None) -> DataFrame:
    return shuffled(assortment, layout, POSITION_KEY, tasks=tasks)


def attach_named(
    facts: DataFrame, products: DataFrame, brands: DataFrame, how: str = "inner", tasks: int = 0
) -> DataFrame:
    """Add product columns and the brand name to rows with a product."""
    named = brand_left_join(products, brands)
    return attach(facts, named, ["product_id"], how, sized_by=(products, brands), tasks=tasks)


def attach_placed(facts: DataFrame, assortment: DataFrame, products: DataFrame, brands: DataFrame) -> DataFrame:
    """Add the current position, product columns and brand name to movements of placed products.

    The three lookups become one by store and product, so that movements are shuffled once at most.
    """
    positions = active_positions(assortment)
    placed = attach_named(positions, products, brands)
    return attach(facts, placed, ["store_id", "product_id"], sized_by=(positions, products, brands))


def layout_left_assortment(layout: DataFrame, assortment: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every slot, empty or not, with the product placed there."""
    return shuffled(layout, assortment, POSITION_KEY, "left", tasks)


def stock_join(assortment: DataFrame, inventory: DataFrame, tasks: int | None = None) -> DataFrame:
    stock = inventory.select("store_id", "product_id", "stock_qty")
    return shuffled(assortment, stock, ["store_id", "product_id"], tasks=tasks)


def new_files(source: DataFrame, processed: DataFrame) -> DataFrame:
    """Source files the ledger does not hold yet."""
    return source.join(processed.select("file_name"), "file_name", "left_anti")
