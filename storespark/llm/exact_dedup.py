"""Exact duplicates by content-defined chunk recipes, in DataFrame expressions only.

A normalised text is cut where its content says so (after punctuation, past a
least length), each chunk is named by a 64-bit identifier, and a document
becomes its recipe: the ordered list of identifiers. Identifiers are verified
over the whole corpus: where one identifier stands for more than one chunk
(by SHA-256), recipes holding it compare the chunks' digests instead. Texts
are read once and never shuffled; what moves is 8 bytes per chunk and recipe
copy, and one pair of identifier and digest per distinct chunk.

Defined cases: a null text counts as empty, and all empty texts are one group.
Of rows alike in length and doc_id one is kept, the others point to it. A null
doc_id comes last among equals. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import kept_rows, materialise, text_or_empty

#: A chunk ends at the first of these characters past LEAST, or after MOST characters.
ENDS = ".,;:!?"
LEAST, MOST = 256, 2048
CHUNK = rf"(?s).{{{LEAST},{MOST}}}?[{ENDS}]|.{{1,{MOST}}}"


def chunk_key(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def normalised(text: Column) -> Column:
    return F.translate(text, " \t\n\x0b\x0c\r", "")


def recipes(docs: DataFrame, key: Callable[[Column], Column] = chunk_key) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_code_points, text_sha256, keys, digests, row tag."""
    cut = docs.select(
        "doc_id",
        F.length(text_or_empty()).cast("long").alias("n_code_points"),
        normalised(text_or_empty()).alias("_norm"),
    )
    chunks = F.regexp_extract_all("_norm", F.lit(CHUNK), F.lit(0))
    return (
        cut.withColumn("_chunks", chunks)
        .select(
            "doc_id",
            "n_code_points",
            F.sha2("_norm", 256).alias("text_sha256"),
            F.transform("_chunks", key).alias("keys"),
            F.transform("_chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )


def shared_keys(recipe: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk, which comparing by identifier must not trust."""
    named = recipe.select(F.explode(F.arrays_zip("keys", "digests")).alias("c")).select(
        F.col("c.keys").alias("key"), F.col("c.digests").alias("digest")
    )
    return named.distinct().groupBy("key").count().where("count > 1").select("key")


def exact_duplicates(docs: DataFrame, key: Callable[[Column], Column] = chunk_key) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chunks: one row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are not read. Of equal texts
    the one with the most code points, then the smallest doc_id, stays.
    """
    recipe = materialise(recipes(docs, key), "recipes")
    # written, so that where none is shared the join below moves nothing
    shared = materialise(shared_keys(recipe), "shared-keys")
    doubtful = recipe.select("_row", F.explode("keys").alias("key")).join(shared, "key").select("_row").distinct()
    # a recipe without a doubtful identifier is compared by identifiers, any other by digests
    verified = recipe.join(doubtful.withColumn("_doubt", F.lit(True)), "_row", "left").select(
        "_row",
        "doc_id",
        "n_code_points",
        "text_sha256",
        F.when(F.col("_doubt"), F.array().cast("array<bigint>")).otherwise(F.col("keys")).alias("ids"),
        F.when(F.col("_doubt"), F.col("digests")).otherwise(F.array().cast("array<binary>")).alias("exact_ids"),
        F.size("keys").cast("long").alias("n_chunks"),
    )
    order = F.struct(-F.col("n_code_points"), F.col("doc_id").isNull(), "doc_id", "_row")
    groups = verified.groupBy("ids", "exact_ids").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(order).alias("_first")
    )
    # only groups of several rows, written, so that the join below shuffles by itself and a hot group can be split
    groups = materialise(
        groups.where("group_size > 1").select(
            "ids",
            "exact_ids",
            "group_size",
            F.col("_first.doc_id").alias("_keep_id"),
            F.col("_first._row").alias("_keep_row"),
        ),
        "groups",
    )
    several = F.col("_keep_row").isNotNull()
    return verified.join(groups, ["ids", "exact_ids"], "left").select(
        "doc_id",
        F.when(several, F.col("_keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (~several | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        "text_sha256",
        "n_chunks",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the texts are shuffled once.

    Rows that repeat both doc_id and normalised text count as one document; its longest text stays.
    """

    def named(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(":", sha, doc_id.cast("string"))

    stay = exact_duplicates(docs).where("kept")
    stay = stay.select(named(F.col("doc_id"), F.col("text_sha256")).alias("_name")).distinct()
    sha = F.sha2(normalised(F.coalesce(docs["text"], F.lit(""))), 256)
    return kept_rows(docs, named(docs["doc_id"], sha), stay)
