"""Batch pipeline: files -> raw -> validated -> fact and stock.

Every step writes its rows into a folder of its own attempt and then appends
one commit row, in one small file. Readers see committed attempts only. A step
that dies leaves an attempt nobody reads; running it again starts a new one, so
no step adds rows twice and no row-level anti join is needed. The commit of a
load covers fact, stock and the loaded state at once. One writer at a time.

Counts of a step are observed while it writes. Files that were rejected or
cannot be read are put in quarantine and left alone until they change.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storespark import schemas
from storespark.functions import fixed_values as fixed
from storespark.operators.joins import active_positions, attach, enrich_shelf_position, fits_broadcast, new_files
from storespark.operators.stock import net_stock_delta
from storespark.operators.validation import CLEANED_COLUMNS, FACT_COLUMNS, validate
from storespark.plans.runlog import RunLog
from storespark.plans.stock_versions import KEPT_SNAPSHOTS, StockVersions
from storespark.sources.csv_files import OTHER_HEADER, hidden_files, list_files, read_in_order
from storespark.sources.writers import append_rows, has_rows, read_or_empty
from storespark.tables import Tables

_MOVED = schemas.TABLES["movements"]
_STORED = {
    "raw_movements": [
        *schemas.TABLES["raw_movements"].fields, "violation boolean", f"{OTHER_HEADER} string", "batch_id bigint",
    ],
    "validated_movements": [
        *[_MOVED[c] for c in CLEANED_COLUMNS],
        "batch_id bigint", "error_reason string", "error_details string", "outcome string",
    ],
    "movements": [_MOVED[c] for c in FACT_COLUMNS],
}
_COMMITS = (
    "step string, batch_id bigint, attempt_id string, origin string, sequence bigint, last_id bigint, committed_at timestamp"
)
_LEDGER = "file_name string, source_system string, processed_at timestamp, batch_id bigint, attempt_id string"
_LISTED = "file_name string, path string, length bigint, modified_at timestamp"
_QUARANTINE = f"{_LISTED}, reason string, rejected_at timestamp"
#: bytes of a header line with every name quoted, a byte order mark and a line end
_HEADER_BYTES = len(",".join(schemas.MOVEMENT_COLUMNS)) + 2 * len(schemas.MOVEMENT_COLUMNS) + 5


def _stored_ddl(name: str) -> str:
    fields = [f if isinstance(f, str) else f"{f.name} {f.dataType.simpleString()}" for f in _STORED[name]]
    return ", ".join([*fields, "attempt_id string"])


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def row_id(after: int) -> Column:
    """Numbers above ``after`` that no other raw row has: position in the batch on top of the last batch's highest.

    Needs no shuffle and no hash. A batch takes 2^33 numbers per task, so 2^30 tasks fit in a warehouse's life;
    beyond that the sum is an error.
    """
    return F.lit(after).cast("bigint") + F.lit(1).cast("bigint") + F.monotonically_increasing_id()


@dataclass(frozen=True)
class StepResult:
    step: str
    files: int = 0
    rows: int = 0
    failed_files: int = 0
    error: str | None = None


class Warehouse:
    """Parquet folders below one root, with their commit log."""

    def __init__(self, spark: SparkSession, root: str, source_system: str = fixed.SOURCE_SYSTEM):
        self.spark, self.root, self.source_system = spark, root.rstrip("/"), source_system
        self.reordered: dict[str, list[str]] = {}
        self.runs = RunLog(spark, self.path("pipeline_runs"))
        self.stock = StockVersions(spark, self.path("inventory"), self.path("stock_manifest"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- commit log ---------------------------------------------------------------------

    def commits(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("step_commits"), _COMMITS)

    def ledger(self) -> DataFrame:
        """Accepted files of committed batches."""
        done = self.commits().filter("step = 'extract'").select("attempt_id").distinct()
        return attach(
            read_or_empty(self.spark, self.path("processed_files"), _LEDGER), done, ["attempt_id"], "left_semi"
        )

    def processed_files(self) -> DataFrame:
        return self.ledger().select(*schemas.TABLES["processed_files"].fieldNames())

    def commit(
        self, step: str, batch_ids: list[int], attempt: str, origin: str | None = None, last_id: int | None = None
    ) -> None:
        """Commits are ordered by their sequence number, not by the clock."""
        sequence = (self.commits().agg(F.max("sequence")).first()[0] or 0) + 1
        rows = self.spark.createDataFrame(
            [(step, b, attempt, origin, sequence, last_id) for b in batch_ids],
            "step string, batch_id bigint, attempt_id string, origin string, sequence bigint, last_id bigint",
        )
        append_rows(rows.coalesce(1).withColumn("committed_at", F.current_timestamp()), self.path("step_commits"))

    def pending(self, step: str, after: str) -> dict[int, str]:
        """Batches the step has not done yet, with the attempt that holds their input: one entry per batch."""
        log = self.commits()
        done = log.filter(F.col("step") == step).select("batch_id")
        todo = log.filter(F.col("step") == after).join(done, "batch_id", "left_anti")
        return {r.batch_id: r.attempt_id for r in todo.select("batch_id", "attempt_id").orderBy("batch_id").collect()}

    def _stored(self, name: str) -> DataFrame:
        return read_or_empty(self.spark, self.path(name), _stored_ddl(name))

    def _attempt_rows(self, name: str, attempts: list[str]) -> DataFrame:
        """Only the attempts' own folders are listed."""
        ddl = _stored_ddl(name)
        return read_or_empty(self.spark, self.path(name), ddl, [f"attempt_id={a}" for a in attempts])

    def _committed(self, name: str, step: str) -> DataFrame:
        log = self.commits().filter(F.col("step") == step)
        return attach(self._stored(name), log.select("attempt_id").distinct(), ["attempt_id"], "left_semi")

    def _write(
        self, df: DataFrame, name: str, partition_by: list[str], gather: str | None = None, **metrics: Column
    ) -> tuple[str, dict]:
        """Write an attempt; returns it with the ``metrics`` observed on the way.

        ``gather`` names a folder column to bring together after a shuffle. Rows still lie in their files' order unless
        a lookup was too big to broadcast; only then they are rebalanced by the folder column, which adaptive execution
        splits again where one value is hot. Metrics are taken in the writing stage itself, where each partition counts
        once, however often a lost one is tried again.
        """
        attempt, seen = uuid.uuid4().hex, Observation()
        if gather:
            df = df.hint("rebalance", F.col(gather))
        df = df.withColumn("attempt_id", F.lit(attempt))
        if metrics:
            df = df.observe(seen, *[column.alias(metric) for metric, column in metrics.items()])
        append_rows(df, self.path(name), ["attempt_id", *partition_by])
        return attempt, seen.get if metrics else {}

    def _exists(self, name: str, attempt: str) -> bool:
        """Whether an attempt wrote any row."""
        return has_rows(self.spark, f"{self.path(name)}/attempt_id={attempt}")

    # -- tables -------------------------------------------------------------------------

    def raw_movements(self) -> DataFrame:
        return self._of_ledger(self._stored("raw_movements")).select(
            *schemas.TABLES["raw_movements"].fieldNames()
        )

    def _of_ledger(self, raw: DataFrame) -> DataFrame:
        """Rows of accepted files. The ledger has one row per file and joins on folder columns only."""
        accepted = self.ledger().select(F.col("file_name").alias("source_file_name"), "attempt_id")
        return attach(raw, accepted, ["source_file_name", "attempt_id"], "left_semi")

    def _validated(self, outcome: str) -> DataFrame:
        rows = self._committed("validated_movements", "transform").filter(F.col("outcome") == outcome)
        log = self.commits()
        cleaned = log.filter("step = 'transform'").select("batch_id", F.col("committed_at").alias("cleaned_at"))
        loaded = log.filter("step = 'load'").select("batch_id", F.col("committed_at").alias("loaded_at"))
        return attach(rows, cleaned.join(loaded, "batch_id", "left"), ["batch_id"])

    def cleaned_movements(self) -> DataFrame:
        return self._validated("clean").select(
            F.col("raw_movement_id").alias("cleaned_movement_id"),
            *CLEANED_COLUMNS,
            F.col("loaded_at").isNotNull().alias("loaded"),
            "cleaned_at",
            "loaded_at",
        )

    def bad_movements(self) -> DataFrame:
        return self._validated("bad").select(
            F.col("raw_movement_id").alias("bad_movement_id"),
            *CLEANED_COLUMNS,
            "error_reason",
            "error_details",
            F.col("cleaned_at").alias("rejected_at"),
            F.lit(False).alias("reviewed"),
            F.lit(False).alias("corrected"),
            F.lit(None).cast("string").alias("correction_notes"),
        )

    def movements(self) -> DataFrame:
        """The fact; a filter on movement_date reads only the folders of these days."""
        return self._committed("movements", "load").select(F.col("raw_movement_id").alias("movement_id"), *FACT_COLUMNS)

    def inventory(self) -> DataFrame:
        return self.stock.read(next(iter(self._snapshots()), None))

    def _snapshots(self) -> list[str]:
        """The attempts of the newest stock manifests, newest first: two commits more than are kept, at most."""
        log = self.commits().filter("step in ('load', 'stock')").groupBy("attempt_id").agg(F.max("sequence").alias("n"))
        return [r.attempt_id for r in log.orderBy(F.desc("n")).limit(KEPT_SNAPSHOTS + 2).collect()]

    def put_table(self, name: str, df: DataFrame) -> None:
        """Replace a master table."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(name))

    def set_inventory(self, stock: DataFrame) -> None:
        """Opening stock: store_id, product_id, stock_qty."""
        rows = stock.select("store_id", "product_id", "stock_qty", F.current_timestamp().alias("updated_at"))
        attempt = uuid.uuid4().hex
        self.stock.write(rows, attempt)
        self.commit("stock", [0], attempt)

    def tables(self) -> Tables:
        masters = ["products", "brands", "store_layout", "store_assortment", "suppliers", "product_suppliers",
                   "products_specifications"]
        stored = Tables.from_parquet(self.spark, self.root, masters)
        states = ["raw_movements", "cleaned_movements", "bad_movements", "movements", "inventory", "processed_files"]
        return stored.replaced(**{n: getattr(self, n) for n in states}, pipeline_runs=self.runs.read)

    # -- steps --------------------------------------------------------------------------

    def store_raw(self, typed: DataFrame, files: DataFrame | None = None, origin: str | None = None) -> StepResult:
        """Write typed movements and accept the files whose rows keep the structure.

        ``files`` lists file_name and length, so that files without rows are
        known too. The CSV is parsed once; file checks read three columns of
        what was written. Files with their columns in another order are not
        decided on: ``reordered`` tells them.
        """
        started = self.runs.start("extract")
        last = self.commits().filter("step = 'extract'").agg(
            F.coalesce(F.max("batch_id"), F.lit(0)).alias("batch"), F.coalesce(F.max("last_id"), F.lit(0)).alias("id")
        ).first()
        batch_id = last["batch"] + 1
        if OTHER_HEADER not in typed.columns:
            typed = typed.withColumn(OTHER_HEADER, F.lit(None).cast("string"))
        rows = typed.withColumns(
            {
                "raw_movement_id": row_id(last["id"]),
                "batch_id": F.lit(batch_id).cast("bigint"),
                "ingestion_timestamp": F.current_timestamp(),
            }
        )
        attempt, seen = self._write(
            rows, "raw_movements", ["source_file_name"],
            broken=F.count_if("violation"), reordered=F.count(OTHER_HEADER), last_id=F.max("raw_movement_id"),
        )
        written = self._attempt_rows("raw_movements", [attempt])
        # where no row was seen that decides on its file, rows per file come from folder names and footers alone
        for metric, column in (("broken", "violation"), ("reordered", OTHER_HEADER)):
            if not seen[metric]:
                written = written.withColumn(column, F.lit(None).cast(written.schema[column].dataType))
        # one row per file, asked a few times; a lost block is counted again from the written rows
        counted = self._file_outcomes(written, files).cache()
        outcomes = counted.filter(F.col("order").isNull())
        ledger = outcomes.filter(F.col("error_message").isNull()).select(
            F.col("source_file_name").alias("file_name"),
            F.lit(self.source_system).alias("source_system"),
            F.current_timestamp().alias("processed_at"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(attempt).alias("attempt_id"),
        )
        append_rows(ledger.coalesce(1), self.path("processed_files"))
        totals = counted.agg(
            F.count_if(F.col("order").isNull()).alias("files"),
            F.coalesce(F.sum(F.when(F.col("order").isNull() & F.col("error_message").isNull(), F.col("rows_success"))), F.lit(0)).alias("rows"),
            F.count_if(F.col("order").isNull() & F.col("error_message").isNotNull()).alias("failed"),
        ).first()
        # logged first: what is committed is never without its rows in the log
        started.finish("extract", outcomes)
        self.commit("extract", [batch_id], attempt, origin, max(seen["last_id"] or 0, last["id"]))
        if files is not None and totals["failed"]:
            failed = outcomes.filter(F.col("error_message").isNotNull())
            self._reject(files, failed.select(F.col("source_file_name").alias("file_name"), F.col("error_message").alias("reason")))
        other = counted.filter(F.col("order").isNotNull()).select("source_file_name", "order").collect()
        self.reordered = {r["source_file_name"]: r["order"].split(",") for r in other}
        counted.unpersist()
        return StepResult("extract", totals["files"], totals["rows"], totals["failed"])

    def _file_outcomes(self, written: DataFrame, files: DataFrame | None) -> DataFrame:
        """A row per file, listed or read; a file that only one side knows, or that lost its rows, is a problem."""
        counted = written.groupBy("source_file_name").agg(
            F.count("*").alias("n"),
            F.count_if("violation").alias("broken"),
            F.max(OTHER_HEADER).alias("order"),
        )
        if files is None:
            counted = counted.withColumns({"length": F.col("n"), "listed": F.lit(True)})
        else:
            per_file = files.groupBy(F.col("file_name").alias("source_file_name")).agg(
                F.sum("length").alias("length"), F.count("*").alias("parts")
            ).withColumn("listed", F.lit(True))
            counted = per_file.join(counted, "source_file_name", "full").fillna(0, ["n", "broken"]).fillna(False, ["listed"])
            counted = counted.withColumn("length", F.coalesce("length", F.lit(1)))
        rows_lost = F.lit(False) if files is None else (F.col("n") == 0) & (F.col("length") > _HEADER_BYTES * F.col("parts"))
        problem = (
            F.when(~F.col("listed"), F.lit("rows of a file that was not listed"))
            .when(F.col("length") == 0, F.lit("no columns to parse from file"))
            .when(rows_lost, F.lit("no row was read from a file that holds more than its header"))
            .when(
                F.col("broken") > 0,
                F.concat(F.col("broken").cast("string"), F.lit(" rows break the raw table's structure")),
            )
        )
        return counted.select(
            "source_file_name",
            F.col("n").alias("rows_processed"),
            F.col("n").alias("rows_success"),
            F.lit(0).cast("bigint").alias("rows_failed"),
            problem.alias("error_message"),
            "order",
        )

    # -- quarantine ---------------------------------------------------------------------

    def quarantine(self) -> DataFrame:
        """Files that were rejected or could not be read, as they were then, with the reason."""
        return read_or_empty(self.spark, self.path("rejected_files"), _QUARANTINE)

    def _reject(self, files: DataFrame, reasons: DataFrame) -> None:
        """``files`` of the drops in ``reasons`` (file_name, reason) are left alone until one of them changes."""
        rows = files.join(reasons, "file_name").withColumn("rejected_at", F.current_timestamp())
        append_rows(rows.select(*_names(_QUARANTINE)).coalesce(1), self.path("rejected_files"))

    def _waiting(self, files: DataFrame) -> DataFrame:
        """Of listed files those whose drop is neither in the ledger nor unchanged in quarantine."""
        as_was = ["path", "length", "modified_at"]
        known = self.quarantine().select(*as_was, F.lit(True).alias("_rejected")).distinct()
        new = new_files(files, self.processed_files()).join(known, as_was, "left")
        changed = new.groupBy("file_name").agg(F.count_if(F.col("_rejected").isNull()).alias("_new")).where("_new > 0")
        return new.join(changed, "file_name", "left_semi").select(*_names(_LISTED))

    # -- steps over files ---------------------------------------------------------------

    def extract(self, folder: str, most: int | None = None) -> StepResult:
        """Read every file that neither ledger nor quarantine knows, in batches of up to ``most`` drops.

        A file that cannot be read fails alone; one with its columns in another order is read in that order. Names that
        the readers pass over count as failed every time and are logged when they are new.
        """
        hidden = hidden_files(self.spark, folder)
        if hidden:
            unseen = self._waiting(self.spark.createDataFrame(hidden, _LISTED)).collect()
            message = "names that start with _ or . are passed over by the readers; rename the file"
            reasons = [(f.file_name, message) for f in unseen]
            if reasons:
                files = self.spark.createDataFrame(unseen, _LISTED)
                self._reject(files, self.spark.createDataFrame(reasons, "file_name string, reason string"))
                self.runs.start("extract").fail_files("extract", reasons)
        result, n = self.extract_listed(folder, list_files(self.spark, folder), most), len(hidden)
        return StepResult("extract", result.files + n, result.rows, result.failed_files + n, result.error)

    def extract_listed(self, folder: str, files: DataFrame, most: int | None = None) -> StepResult:
        """``extract`` of the drops among ``files`` (file_name, path, length, modified_at); the folder is not listed."""
        # one entry per new file, which Spark's own file index holds on the driver anyway; fixed before the ledger grows
        found = self._waiting(files).orderBy("file_name", "path").collect()
        names = list(dict.fromkeys(f.file_name for f in found))
        batch_of = {name: i // (most or len(names)) for i, name in enumerate(names)}
        batches = [list(group) for _, group in groupby(found, key=lambda f: batch_of[f.file_name])]
        return self._sum([self._extract_files(folder, batch) for batch in batches])

    def _extract_files(self, folder: str, found: list, order: list[str] | None = None) -> StepResult:
        """``found`` as one batch; where a file cannot be read, its halves, down to the drop that is at fault.

        A drop that cannot be read goes to quarantine; any other error is the step's and its files are tried again.
        """
        files = self.spark.createDataFrame(found, _LISTED)
        try:
            typed = read_in_order(self.spark, [f.path for f in found], self.source_system, folder, order)
            done = self.store_raw(typed, files)
        except Exception as error:
            names = list(dict.fromkeys(f.file_name for f in found))
            unreadable = "FAILED_READ_FILE" in str(error)
            if unreadable and len(names) > 1:
                self.runs.fail("extract", f"{len(names)} drops are read in two parts, as one cannot be read: {error}")
                first = set(names[: len(names) // 2])
                parts = [[f for f in found if (f.file_name in first) == side] for side in (True, False)]
                return self._sum([self._extract_files(folder, part, order) for part in parts])
            failures = [(name, str(error)) for name in names]
            self.runs.fail_files("extract", failures)
            if unreadable:
                self._reject(files, self.spark.createDataFrame(failures, "file_name string, reason string"))
            return StepResult("extract", files=len(names), failed_files=len(names), error=None if unreadable else str(error))
        results, reordered = [done], {name: tuple(o) for name, o in self.reordered.items()}
        for other in sorted(set(reordered.values())):
            again = [f for f in found if reordered.get(f.file_name) == other]
            results.append(self._extract_files(folder, again, list(other)))
        return self._sum(results)

    @staticmethod
    def _sum(results: list[StepResult]) -> StepResult:
        error = next((r.error for r in results if r.error), None)
        totals = [sum(getattr(r, f) for r in results) for f in ("files", "rows", "failed_files")]
        return StepResult("extract", *totals, error)

    def _guarded(self, step: str, files: DataFrame, work: Callable[[], StepResult]) -> StepResult:
        try:
            return work()
        except Exception as error:
            nothing = F.lit(None).cast("bigint")
            failed = files.select(F.col("file_name").alias("source_file_name")).distinct().select(
                "source_file_name", nothing.alias("rows_processed"), nothing.alias("rows_success"),
                nothing.alias("rows_failed"), F.lit(str(error)).alias("error_message"),
            )
            self.runs.finish(step, failed)
            return StepResult(step, failed_files=failed.count(), error=str(error))

    def transform(self) -> StepResult:
        """Validate accepted raw rows. Clean and bad rows are written in one pass, into folders of their own."""
        todo = self.pending("transform", "extract")
        if not todo:
            return StepResult("transform")
        self.runs.start("transform")
        raw = self._of_ledger(self._attempt_rows("raw_movements", list(todo.values())))
        files = self.ledger().filter(F.col("batch_id").isin(list(todo))).select("file_name")
        return self._guarded("transform", files, lambda: self._transform(raw, list(todo)))

    def _transform(self, raw: DataFrame, batches: list[int]) -> StepResult:
        products, suppliers = self._master("products"), self._master("suppliers")
        rows = validate(raw.select(*CLEANED_COLUMNS, "batch_id"), products, suppliers)
        outcome = F.when(F.col("error_reason").isNull(), "clean").otherwise("bad")
        in_place = fits_broadcast(products.select("product_id")) and fits_broadcast(suppliers.select("supplier_id"))
        attempt, seen = self._write(
            rows.withColumn("outcome", outcome),
            "validated_movements",
            ["outcome", "source_file_name"],
            gather=None if in_place else "source_file_name",
            rows=F.count(F.lit(1)),
        )
        # folder columns only: counts come from file footers
        counts = self._attempt_rows("validated_movements", [attempt]).groupBy("source_file_name").agg(
            F.count("*").alias("rows_processed"),
            F.count_if(F.col("outcome") == "clean").alias("rows_success"),
            F.count_if(F.col("outcome") == "bad").alias("rows_failed"),
        )
        files = self.runs.finish("transform", counts.withColumn("error_message", F.lit(None).cast("string")))
        self.commit("transform", batches, attempt)
        return StepResult("transform", files, seen["rows"])

    def _master(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.TABLES[name]).parquet(self.path(name))

    def load(self) -> StepResult:
        """Enrich clean rows, add them to the fact and to stock, in one commit. Errors are logged and raised."""
        todo = self.pending("load", "transform")
        if not todo:
            return StepResult("load")
        attempts = sorted(set(todo.values()))
        if not any(self._exists("validated_movements", f"{a}/outcome=clean") for a in attempts):
            self.commit_without_rows(list(todo))
            return StepResult("load")
        self.runs.start("load")
        try:
            # a transform attempt may cover batches that were loaded before
            clean = self._attempt_rows("validated_movements", attempts).filter(
                (F.col("outcome") == "clean") & F.col("batch_id").isin(list(todo))
            )
            assortment = self._master("store_assortment")
            enriched = enrich_shelf_position(clean, assortment).select(*FACT_COLUMNS)
            gather = None if fits_broadcast(active_positions(assortment)) else "movement_date"
            before = next(iter(self._snapshots()), None)
            attempt, seen = self._write(enriched, "movements", ["movement_date"], gather, rows=F.count(F.lit(1)))
            self.stock.apply(net_stock_delta(self._attempt_rows("movements", [attempt])), before, attempt)
            n = seen["rows"]
            self.runs.complete("load", n, n, 0)
            self.commit("load", list(todo), attempt)
        except Exception as error:
            self.runs.fail("load", str(error))
            raise
        self.stock.expire(self._snapshots())
        return StepResult("load", rows=n)

    def commit_without_rows(self, batches: list[int]) -> None:
        """Close batches that hold no clean row; stock keeps its last version."""
        self.commit("load", batches, next(iter(self._snapshots()), uuid.uuid4().hex))

    def run(self, folder: str) -> list[StepResult]:
        """All new files through the three steps, as one batch whatever the number of days."""
        return [self.extract(folder), self.transform(), self.load()]
