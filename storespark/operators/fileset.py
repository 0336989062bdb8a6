"""File sets of the pipeline: one row per file, never per movement, after the first step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def files_in_order(files: DataFrame, column: str = "file_name") -> DataFrame:
    return files.orderBy(column)


def files_to_transform(raw: DataFrame, cleaned: DataFrame, bad: DataFrame) -> DataFrame:
    """Raw files of which no row has reached the clean or the bad table."""
    name = "source_file_name"
    done = cleaned.select(name).union(bad.select(name)).distinct()
    return raw.select(name).distinct().subtract(done)


def raw_for_file(raw: DataFrame, file_name: str) -> DataFrame:
    """Rows of one file; on a table partitioned by file only its folder is read."""
    return raw.filter(F.col("source_file_name") == file_name)


def mark_file_processed(ledger: DataFrame, files: DataFrame, source_system: str, now=None) -> DataFrame:
    """The ledger with the given files added."""
    now = F.current_timestamp() if now is None else now
    added = files.select(
        "file_name", F.lit(source_system).alias("source_system"), now.cast("timestamp").alias("processed_at")
    )
    return ledger.unionByName(added)


def table_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
