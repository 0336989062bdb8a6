"""Run log: one row per step and file."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storespark.schemas import TABLES
from storespark.sources.writers import append_rows, read_or_empty

RUN_COLUMNS = [f.name for f in TABLES["pipeline_runs"].fields]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def duration_seconds(started_at, completed_at):
    """Elapsed seconds with two digits."""
    micros = F.unix_micros(completed_at) - F.unix_micros(started_at)
    return F.round(micros.cast("decimal(20,0)") / F.lit(1000000), 2).cast("decimal(10,2)")


def run_rows(outcomes: DataFrame, step: str, started_at: dt.datetime, completed_at: dt.datetime) -> DataFrame:
    """Run log rows (without id) of ``outcomes``: source_file_name, three row counts and error_message.

    A row with an error message is a failed run; counts of failed runs stay empty.
    """
    started = F.lit(started_at).cast("timestamp")
    completed = F.lit(completed_at).cast("timestamp")
    failed = F.col("error_message").isNotNull()
    counts = [
        F.when(~failed, F.col(c)).cast("bigint").alias(c) for c in ("rows_processed", "rows_success", "rows_failed")
    ]
    return outcomes.select(
        F.lit(step).alias("pipeline_step"),
        "source_file_name",
        F.when(failed, "failed").otherwise("success").alias("status"),
        *counts,
        "error_message",
        started.alias("started_at"),
        completed.alias("completed_at"),
        duration_seconds(started, completed).alias("duration_seconds"),
    )


@dataclass
class RunLog:
    """Appends finished runs to a Parquet folder."""

    spark: SparkSession
    path: str
    started_at: dt.datetime = field(default_factory=utc_now)

    def start(self, step: str | None = None) -> RunLog:
        """Begin a run; with a step, a ``running`` row tells of it even if the job is killed."""
        self.started_at = utc_now()
        if step:
            running = self._one(None, None, None, None, None)
            rows = run_rows(running, step, self.started_at, self.started_at).withColumns(
                {"status": F.lit("running"), "completed_at": F.lit(None).cast("timestamp"),
                 "duration_seconds": F.lit(None).cast("decimal(10,2)"), "run_id": F.lit(self._next_id()).cast("bigint")}
            )
            append_rows(rows.coalesce(1).select(*RUN_COLUMNS), self.path)
        return self

    def fail_files(self, step: str, failures: list[tuple[str, str]]) -> None:
        """A failed row per file, with the whole message."""
        ddl = "source_file_name string, error_message string"
        nothing = F.lit(None).cast("bigint")
        rows = self.spark.createDataFrame(failures, ddl)
        self.finish(step, rows.withColumns({c: nothing for c in ("rows_processed", "rows_success", "rows_failed")}))

    def _rows(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, TABLES["pipeline_runs"])

    def read(self) -> DataFrame:
        """All runs; a ``running`` row is shown only until its step has logged how it ended."""
        rows, begun = self._rows(), ["pipeline_step", "started_at"]
        ended = rows.filter("status <> 'running'").select(*begun).distinct()
        open_runs = rows.filter("status = 'running'").join(ended, begun, "left_anti").select(*RUN_COLUMNS)
        return rows.filter("status <> 'running'").unionByName(open_runs)

    def _next_id(self) -> int:
        return (self._rows().agg(F.max("run_id")).first()[0] or 0) + 1

    def finish(self, step: str, outcomes: DataFrame) -> int:
        """Log a row per outcome; tells how many they were."""
        rows, written = run_rows(outcomes, step, self.started_at, utc_now()), Observation()
        # one row per file: a single small output file with consecutive ids
        numbered = rows.coalesce(1).withColumn("run_id", F.monotonically_increasing_id() + self._next_id())
        append_rows(numbered.select(*RUN_COLUMNS).observe(written, F.count(F.lit(1)).alias("rows")), self.path)
        return written.get["rows"]

    def complete(self, step: str, processed: int, success: int, failed: int, file_name: str | None = None) -> None:
        self.finish(step, self._one(file_name, processed, success, failed, None))

    def fail(self, step: str, message: str, file_name: str | None = None) -> None:
        self.finish(step, self._one(file_name, None, None, None, message))

    def _one(self, *values) -> DataFrame:
        ddl = (
            "source_file_name string, rows_processed bigint, rows_success bigint, rows_failed bigint, "
            "error_message string"
        )
        return self.spark.createDataFrame([values], ddl)
