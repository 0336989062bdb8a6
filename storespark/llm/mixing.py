"""Mixing sources to target weights by capped water-filling, in DataFrame expressions only.

Sources share the words of the corpus by weight. A source whose share passes
``epochs`` times its own words is clamped there, and the excess goes to the
others in proportion to their weights, until none is above its cap. Each
source then takes whole repetitions of all its documents, and one fractional
repetition of a seeded selection: documents in hash order up to the words that
are missing, the last one only if it brings the sum nearer.

Texts are read once; everything later works on ids and sizes. The selection
ranks no whole source: hash buckets are summed per source, and only the bucket
in which the missing words end is ordered.

Defined cases: a null text has no words; documents without words take none; a
null source is a source of its own, last in order; an empty table gives an
empty result; rows alike in all columns are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storespark.llm.common import materialise, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Hash buckets per source; the one where the missing words end is the only one that is ordered.
BUCKETS = 4096


def sizes(docs: DataFrame, seed: str = SEED, *tags: str) -> DataFrame:
    """doc_id, source, size, hash position and bucket of every row, with the columns ``tags``."""
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select(
        *tags, "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), place.alias("_place")
    ).withColumn("_bucket", F.conv(F.substring("_place", 1, 3), 16, 10).cast("int"))


def numbered(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, null last, without gathering them in one task."""
    ranged = materialise(
        sources.withColumn("_last", F.col("source").isNull())
        .repartitionByRange("_last", "source")
        .withColumn("_part", F.spark_partition_id()),
        "sources",
    )
    counts = ranged.groupBy("_part").count()
    before = counts.select(
        "_part",
        (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"),
    )  # a row per partition, however many sources there are
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_last", "source")) - 1
    return (
        ranged.withColumn("_inside", inside)
        .join(before, "_part")
        .withColumn("number", F.col("_before") + F.col("_inside"))
        .drop("_part", "_last", "_inside", "_before")
    )


def water_filling(sources: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds weight and target to (source, source_size); targets add up to all words.

    One row of sums per round comes to the driver. A round clamps every source
    above its cap at the present level, so the level only rises, and the rounds
    end when it clamps no further source.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    filled = materialise(numbered(sources).withColumn("weight", weight.cast("long")), "weights")
    cap = F.col("source_size") * epochs
    total, rest_weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, clamped, level = total or 0, 0, None
    while rest_weight:
        level = float(rest) / float(rest_weight)
        above = F.lit(level) * F.col("weight") > cap
        n, capped, free_weight = filled.agg(
            F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == clamped:
            break
        clamped, rest, rest_weight = n, total - (capped or 0), free_weight or 0
    share = F.lit(level or 0.0) * F.col("weight")
    return filled.withColumn("target", F.least(share, cap.cast("double")))


def source_plan(sized: DataFrame, epochs: int, weights: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Per source: size, target, whole repetitions, missing words and where they end; and the sums per bucket."""
    buckets = materialise(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_words")), "buckets")
    totals = buckets.groupBy("source").agg(F.sum("_words").alias("source_size"))
    filled = water_filling(totals, epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = filled.withColumn("_whole", whole).withColumn(
        "_missing", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    ordered = Window.partitionBy("source").orderBy("_bucket")  # at most BUCKETS rows
    before = F.sum("_words").over(ordered) - F.col("_words")
    ends = (
        buckets.withColumn("_before", before)
        .join(plan.select(F.col("source").alias("_s"), "_missing"), F.col("source").eqNullSafe(F.col("_s")))
        .where((F.col("_before") < F.col("_missing")) & (F.col("_words") > 0))
        .groupBy("source")
        .agg(F.max(F.struct("_bucket", "_before")).alias("_end"))
        .select(F.col("source").alias("_s"), F.col("_end._bucket").alias("_end"), F.col("_end._before").alias("_before"))
    )
    plan = plan.join(ends, plan["source"].eqNullSafe(ends["_s"]), "left").select(
        plan["source"].alias("_source"),
        "source_size",
        "target",
        "_whole",
        "_missing",
        F.coalesce("_end", F.lit(-1)).alias("_end"),
        F.coalesce("_before", F.lit(0)).alias("_before"),
    )
    return materialise(plan, "mix"), buckets


def mix(docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats and taken of every row of ``docs``.

    ``docs`` needs doc_id, text and source; other columns are not read.
    """
    sized = materialise(sizes(docs, seed), "sizes")
    return _repeats(sized, *source_plan(sized, epochs, weights)).select(
        "doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")
    )


def _repeats(sized: DataFrame, plan: DataFrame, _buckets: DataFrame) -> DataFrame:
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["_source"]))
    early = F.when(F.col("_bucket") < F.col("_end"), 1).otherwise(0)
    done = rows.where(F.col("_bucket") != F.col("_end")).withColumn("repeats", F.col("_whole") + early)
    inside = Window.partitionBy("source").orderBy("_place", F.col("doc_id").isNull(), "doc_id", "size")
    reached = F.col("_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    last = (
        rows.where(F.col("_bucket") == F.col("_end"))
        .withColumn("_reached", reached)
        .withColumn("repeats", F.col("_whole") + F.when(_nearer(), 1).otherwise(0))
        .drop("_reached")
    )
    return done.unionByName(last)


def _nearer() -> Column:
    """Whether a document belongs to the selection: its middle lies inside the missing words."""
    return F.col("_reached") - F.col("size") / 2 <= F.col("_missing")


def repeat_documents(
    docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED
) -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it, with the columns of ``docs``.

    Rows are written with a tag first, so each row has its own part of the plan, whatever its columns have in common.
    """
    tagged = docs.select(F.monotonically_increasing_id().alias("_tag"), F.struct(*docs.columns).alias("_doc"))
    tagged = materialise(tagged, "tagged")
    fields = tagged.select("_tag", *[F.col(f"_doc.{c}").alias(c) for c in ("doc_id", "text", "source")])
    sized = materialise(sizes(fields, seed, "_tag"), "sizes")
    chosen = _repeats(sized, *source_plan(sized, epochs, weights)).where("repeats > 0").select("_tag", "repeats")
    rows = tagged.join(chosen, "_tag").select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), "repeats")).alias("_copy"))
    return rows.select("_doc.*")
