"""Sinks over Parquet folders and CSV."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _partitioned(df: DataFrame, partition_by: list[str] | None):
    return df.write.partitionBy(*partition_by) if partition_by else df.write


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    _partitioned(df, partition_by).mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace all rows. The frame must not read the same path."""
    writer = _partitioned(df, partition_by).mode("overwrite")
    writer.option("partitionOverwriteMode", "static").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace just the partitions the frame holds, so that a repeated write adds nothing."""
    _partitioned(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def replace_table(df: DataFrame, path: str, schema: StructType) -> None:
    """Replace rows and schema by the declared one; absent columns become null."""
    present = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    full_refresh(df.select(*columns), path)


def has_rows(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException:
        return False


def read_or_empty(
    spark: SparkSession, path: str, schema: StructType | str, folders: list[str] | None = None
) -> DataFrame:
    """The rows of a table's folder, or of some folders in it; none where nothing has been written yet."""
    if folders is not None:
        folders = [f"{path}/{f}" for f in folders if folder_exists(spark, f"{path}/{f}")]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", path).parquet(*folders)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def load_once(df: DataFrame, path: str) -> bool:
    """Append only where the target has no rows; tells whether it did."""
    if has_rows(df.sparkSession, path):
        return False
    append_rows(df, path)
    return True


def write_csv(df: DataFrame, path: str, sep: str = ",", partition_by: list[str] | None = None) -> None:
    """CSV with a header and no index column."""
    writer = _partitioned(df, partition_by).mode("errorifexists").option("header", True).option("sep", sep)
    writer = writer.option("quote", '"').option("escape", '"')
    writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
