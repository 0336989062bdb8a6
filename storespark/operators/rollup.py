"""Sums of movements by keys that live on lookup tables.

``summed_by`` has two shapes with equal results. When every lookup is small
enough to broadcast, movements are joined in place and only partial sums are
shuffled. Otherwise movements are first summed by their own keys, so that the
join shuffles one row per key: a product that holds a third of all movements is
then no heavier than any other.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.operators.joins import attach, fits_broadcast


@dataclass(frozen=True)
class Lookup:
    frame: DataFrame
    on: tuple[str, ...]
    how: str = "inner"


def additive(movements: DataFrame, keys: list[str], **measures: Column) -> DataFrame:
    """Keys and additive measures of each movement: its count ``n``, its ``qty`` and what else is named."""
    return movements.select(
        *keys,
        F.lit(1).cast("bigint").alias("n"),
        F.col("quantity").cast("bigint").alias("qty"),
        *[expr.alias(name) for name, expr in measures.items()],
    )


def collapsed(facts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with all other columns summed."""
    measures = [c for c in facts.columns if c not in keys]
    return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def summed_by(
    facts: DataFrame,
    keys: list[str],
    lookups: list[Lookup],
    by: list[str],
    sums: Mapping[str, Column],
    collapse: bool | None = None,
) -> DataFrame:
    """Attach lookups to additive facts and aggregate by ``by``.

    ``collapse`` forces or forbids the first summing; None decides by the size of the lookups.
    """
    small = [fits_broadcast(lookup.frame) for lookup in lookups]
    rows = collapsed(facts, keys) if (not all(small) if collapse is None else collapse) else facts
    for lookup, fits in zip(lookups, small):
        rows = attach(rows, lookup.frame, list(lookup.on), lookup.how, small=fits)
    return rows.groupBy(*by).agg(*[expr.alias(name) for name, expr in sums.items()])
