"""Helpers the operators of this package share: tables, scratch copies, hashes, folds, batches."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import storespark
from storespark.session import shared_folder

#: Rows per Arrow batch: documents are long, and a batch lies in memory as a whole.
BATCH_ROWS = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy cuts the lineage, outlives lost executors and fixes row tags.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_ready(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """What Arrow passes need: this package on the workers, and a bound on the texts one batch carries.

    The bound only ever lowers the session's setting.
    """
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application."""
    context = spark.sparkContext
    if getattr(context, "_storespark_shipped", False):
        return
    top = Path(storespark.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="storespark-")) / "storespark.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, str(file.relative_to(top.parent)))
    context.addPyFile(str(archive))
    context._storespark_shipped = True


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id counts as the text ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_name(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text; only rows that repeat both share a name."""
    text = F.coalesce(text, F.lit(""))
    return F.concat_ws(":", doc_id.cast("string"), F.xxhash64(text).cast("string"), F.length(text).cast("string"))


def kept_rows(docs: DataFrame, name: Column, stay: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``name`` is in ``stay`` (_name), with all their columns.

    The texts are shuffled once. Of rows that share a name, the longest text stays.
    """
    rows = docs.select(name.alias("_name"), F.struct(*docs.columns).alias("_doc"))
    kept = rows.join(stay, "_name", "left_semi")
    longest = F.max_by("_doc", F.length(F.coalesce("_doc.text", F.lit("")))).alias("_doc")
    return kept.groupBy("_name").agg(longest).select("_doc.*")
