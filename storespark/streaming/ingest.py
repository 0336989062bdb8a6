"""The drop folder as a stream.

An epoch takes the files of its own micro-batch, by name, length and time;
contents are read by the warehouse. The first epoch of a run lists the folder
once, so that files without rows and files that another checkpoint passed over
are taken too; later epochs list nothing but the folders of drops that have
parts. What is loaded is decided by ledger and quarantine, as in a batch: a file
that was taken, or rejected and has not changed since, is left alone, a drop of
several parts is accepted or rejected as a whole, and a file that cannot be
read ends neither the epoch nor the stream. A replayed epoch finds nothing new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from storespark.plans.pipeline import StepResult, Warehouse
from storespark.sources.csv_files import (
    OTHER_HEADER,
    listed_stream,
    movement_text,
    path_below,
    type_movements,
    with_all_parts,
)


def movement_stream(
    spark: SparkSession, folder: str, source_system: str = "simulated_api", max_files: int | None = None
) -> DataFrame:
    """Typed movements of files as they arrive."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return type_movements(movement_text(reader, folder, path_below(spark, folder)), source_system).drop(OTHER_HEADER)


def _extract_epoch(
    warehouse: Warehouse, folder: str, max_files: int | None, files: DataFrame | None = None
) -> StepResult:
    """Drops of the listed ``files``, or of the whole folder; errors that are no file's own are raised."""
    if files is None:
        done = warehouse.extract(folder, max_files)
    else:
        done = warehouse.extract_listed(folder, with_all_parts(files, folder), max_files)
    if done.error:
        raise RuntimeError(done.error)
    return done


def _each_epoch(
    warehouse: Warehouse, folder: str, checkpoint: str, max_files: int | None, after: Callable[[], None]
) -> StreamingQuery:
    files = listed_stream(warehouse.spark, folder, max_files)
    listed_once = []

    def epoch(batch: DataFrame, number: int) -> None:
        _extract_epoch(warehouse, folder, max_files, batch if listed_once else None)
        listed_once.append(number)
        after()

    writer = files.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(epoch).start()


def stream_ingest(
    warehouse: Warehouse, folder: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Raw rows of every new file, once."""
    return _each_epoch(warehouse, folder, checkpoint, max_files, lambda: None)


def stream_pipeline(
    warehouse: Warehouse, folder: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Raw, validated, fact and stock of every new file, once."""

    def after() -> None:
        done = warehouse.transform()
        if done.error:
            raise RuntimeError(done.error)
        warehouse.load()

    return _each_epoch(warehouse, folder, checkpoint, max_files, after)
