"""Ranks, samples and first-of-group picks that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLITS = 256


def numbered(keys: DataFrame, column: str, name: str = "i") -> DataFrame:
    """Position (from 0) of each distinct value of ``column`` in ascending order.

    Up to ``SPLITS`` values picked by hash cut the order into ranges. A value's
    position is the number of values in lower ranges plus its place in its own
    range, so no task sorts more than one range. The cut points only spread the
    work; the result does not depend on them.
    """
    by_hash = keys.orderBy(F.xxhash64(column), column).limit(SPLITS)
    cuts = by_hash.agg(F.array_sort(F.collect_list(column)).alias("cuts"))
    # never null, so that the join on it adds no filter below the distinct
    place_in_cuts = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut <= F.col(column))), F.lit(0))
    ranged = keys.withColumn("_cuts", cuts.scalar()).withColumn("_range", place_in_cuts).drop("_cuts")
    # one row per range, at most SPLITS + 1
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(W.partitionBy("_range").orderBy(column))
    return (
        ranged.withColumn("_place", place)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.col("_place") - 1)
        .drop("_range", "_place", "_offset")
    )


def _bucket(order: Column, buckets: int) -> Column:
    return F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint") * buckets / 2**32).cast("int")


class SampleEnd(NamedTuple):
    """Where a category's sample ends: at a hash, and within its rows at a second hash and a number of equal rows.

    Without ``tie`` all rows of the hash stay, without ``equal`` all of the second hash.
    """

    order: str
    tie: int | None = None
    equal: int | None = None


def _per_category(category: Column, values: Mapping[str, object]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), category)


def _cut(keys: DataFrame, category: str, value: Column, needs: Mapping[str, int]) -> dict[str, tuple]:
    """Per category, in order of ``value``: the value at which ``needs`` rows are reached, what of it counts, its rows."""
    if not needs:
        return {}
    counts = keys.filter(F.col(category).isin(list(needs))).groupBy(category, value.alias("_v")).agg(F.count("*").alias("_n"))
    below = F.sum("_n").over(W.partitionBy(category).orderBy("_v")) - F.col("_n")
    left = _per_category(F.col(category), needs) - F.col("_below")
    placed = counts.withColumn("_below", below).withColumn("_left", left)
    found = placed.filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_n"))).collect()
    return {r[category]: (r["_v"], r["_left"], r["_n"]) for r in found}


def _at(category: str, value: Column, cuts: Mapping[str, tuple]) -> Column:
    return F.coalesce(value == _per_category(F.col(category), {c: cut[0] for c, cut in cuts.items()}), F.lit(False))


def _tie(columns: list[str]) -> Column:
    return F.xxhash64(F.lit("tie"), *columns)


def sample_ends(
    df: DataFrame, category: str, order: Column, shares: Mapping[str, float], buckets: int = 4096
) -> dict[str, SampleEnd]:
    """Where the sample of each listed category ends; one row per category comes to the driver.

    One scan reads category and hash, which are counted by hash bucket, and by hash in the bucket where the quota ends.
    Only if some rows of one hash stay and others go are these read again, and counted by a hash of all columns.
    """
    keys = df.filter(F.col(category).isin(list(shares))).select(category, order.alias("_order")).persist()
    try:
        sizes = {r[category]: r["count"] for r in keys.groupBy(category).count().collect()}
        share = {c: Decimal(str(shares[c])).quantize(Decimal("0.000001"), ROUND_HALF_UP) for c in sizes}
        quota = {c: int((share[c] * n).to_integral_value(ROUND_HALF_EVEN)) for c, n in sizes.items()}
        bucket = _bucket(F.col("_order"), buckets)
        ends = _cut(keys, category, bucket, {c: min(q, sizes[c]) for c, q in quota.items() if q > 0})
        inside = keys.filter(_at(category, bucket, ends)) if ends else keys
        lasts = _cut(inside, category, F.col("_order"), {c: left for c, (_, left, _) in ends.items()})
    finally:
        keys.unpersist()
    found = {c: SampleEnd(last) for c, (last, _, _) in lasts.items()}
    split = {c: cut for c, cut in lasts.items() if cut[1] < cut[2]}
    if split:
        # a hash of any size is spread by ranges of the second hash
        tied = df.filter(_at(category, order, split)).select(category, _tie(df.columns).alias("_tie"))
        ranges = _cut(tied, category, F.shiftright("_tie", 48), {c: left for c, (_, left, _) in split.items()})
        inside = tied.filter(_at(category, F.shiftright("_tie", 48), ranges))
        for c, (tie, left, n) in _cut(inside, category, F.col("_tie"), {c: cut[1] for c, cut in ranges.items()}).items():
            found[c] = SampleEnd(split[c][0], tie, left if left < n else None)
    return found


def in_sample(category: str, order: Column, columns: list[str], ends: Mapping[str, SampleEnd]) -> Column:
    """Whether a row is in the sample; where only some of fully equal rows are, ``equal_rows`` come besides."""
    inside = F.lit(False)
    for name, end in ends.items():
        at_end = order == end.order
        if end.tie is not None:
            at_end = at_end & (_tie(columns) < end.tie if end.equal else _tie(columns) <= end.tie)
        inside = F.when(F.col(category) == name, (order < end.order) | at_end).otherwise(inside)
    return F.coalesce(inside, F.lit(False))


def equal_rows(rows: DataFrame, category: str, order: Column, ends: Mapping[str, SampleEnd]) -> DataFrame | None:
    """Of equal rows at an end as many as are in the sample; None where no end lies among equal rows."""
    among = {c: end for c, end in ends.items() if end.equal}
    if not among:
        return None
    columns = rows.columns
    at = [(F.col(category) == c) & (order == e.order) & (_tie(columns) == e.tie) for c, e in among.items()]
    kinds = rows.filter(reduce(lambda a, b: a | b, at)).groupBy(*columns).agg(F.count("*").alias("_n"))
    # a kind each, or a few where the second hash collides
    before = F.sum("_n").over(W.partitionBy(category).orderBy(*columns)) - F.col("_n")
    wanted = _per_category(F.col(category), {c: e.equal for c, e in among.items()})
    kept = kinds.withColumn("_keep", F.least(F.col("_n"), wanted - before)).filter("_keep > 0")
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_keep")))).select(*columns)


def sampled(rows: DataFrame, category: str, order: Column, ends: Mapping[str, SampleEnd], besides: Column | None = None) -> DataFrame:
    """The sample that ``ends`` describes: one filter over one scan. Rows that hold ``besides`` stay, and are not drawn from."""
    inside = in_sample(category, order, rows.columns, ends)
    drawn = rows if besides is None else rows.filter(~besides)
    kept = rows.filter(inside if besides is None else besides | inside)
    equal = equal_rows(drawn, category, order, ends)
    return kept if equal is None else kept.unionAll(equal)


def sample_by_category(
    df: DataFrame, category: str, order: Column, shares: Mapping[str, float], buckets: int = 4096
) -> DataFrame:
    """Exactly half-even-round(share x size) rows of each listed category, lowest ``order`` (a hex hash) first.

    The ends are found at once, by one scan of category and hash; the rows are then filtered by them. Categories not
    listed are dropped, as are null ones; of rows with one hash at the end those with the lowest second hash stay.
    """
    return sampled(df, category, order, sample_ends(df, category, order, shares, buckets))


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The lowest-ordered row of each key, as a partial aggregate: copies collapse before the shuffle."""
    picked = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(picked).select("_row.*")
