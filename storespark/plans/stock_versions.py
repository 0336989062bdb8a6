"""Stock as versions per store, and the manifest that tells which one counts.

A change of stock writes the rows of the stores it touches, each store into a
folder of its own below the attempt, and then the attempt's manifest: for
every store the attempt that holds its present rows. A manifest has one row a
store; stores that did not move keep their folder. Versions that no kept
manifest names are deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storespark import schemas
from storespark.operators.joins import attach
from storespark.operators.stock import inventory_apply
from storespark.sources.writers import append_rows, delete_folder, read_or_empty

#: manifests that stay: the present one and those that readers may still hold
KEPT_SNAPSHOTS = 2
_COLUMNS = schemas.TABLES["inventory"].fieldNames()
_ROWS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TABLES["inventory"].fields) + ", attempt_id string"
_MANIFEST = f"store_id {schemas.TABLES['inventory']['store_id'].dataType.simpleString()}, version string, attempt_id string"


@dataclass(frozen=True)
class StockVersions:
    spark: SparkSession
    rows_path: str
    manifest_path: str

    def manifest(self, attempt: str | None) -> DataFrame:
        """(store_id, version) as of a committed attempt; no rows where there is none."""
        folders = [f"attempt_id={attempt}"] if attempt else []
        return read_or_empty(self.spark, self.manifest_path, _MANIFEST, folders).select("store_id", "version")

    def read(self, attempt: str | None) -> DataFrame:
        return self._of(self.manifest(attempt))

    def _of(self, manifest: DataFrame) -> DataFrame:
        """Stock of the stores in ``manifest``; only attempts that it names are listed."""
        # as many attempts as there are different last loads of a store
        versions = sorted(r["version"] for r in manifest.select("version").distinct().collect())
        rows = read_or_empty(self.spark, self.rows_path, _ROWS, [f"attempt_id={v}" for v in versions])
        named = manifest.select("store_id", F.col("version").alias("attempt_id"))
        return attach(rows, named, ["store_id", "attempt_id"], "left_semi").select(_COLUMNS)

    def write(self, stock: DataFrame, attempt: str, others: DataFrame | None = None) -> None:
        """Rows of some stores as a new version, and a manifest of these and of the ``others``."""
        append_rows(stock.withColumn("attempt_id", F.lit(attempt)), self.rows_path, ["attempt_id", "store_id"])
        # folder columns only, no row is read again
        written = read_or_empty(self.spark, self.rows_path, _ROWS, [f"attempt_id={attempt}"]).select("store_id").distinct()
        manifest = written.withColumn("version", F.lit(attempt))
        if others is not None:
            manifest = manifest.unionByName(others)
        append_rows(manifest.coalesce(1).withColumn("attempt_id", F.lit(attempt)), self.manifest_path, ["attempt_id"])

    def apply(self, delta: DataFrame, before: str | None, attempt: str) -> None:
        """Stock after a net change: stores without a change are neither read nor written."""
        manifest = self.manifest(before)
        touched = delta.select("store_id").distinct()
        moved = attach(manifest, touched, ["store_id"], "left_semi")
        self.write(inventory_apply(self._of(moved), delta), attempt, attach(manifest, touched, ["store_id"], "left_anti"))

    def expire(self, attempts: list[str]) -> None:
        """Delete what only manifests beyond the kept ones name; ``attempts`` are committed ones, newest first."""
        kept, old = attempts[:KEPT_SNAPSHOTS], attempts[KEPT_SNAPSHOTS:]
        if not old:
            return
        held = self._all(kept)
        gone = self._all(old).join(held, ["store_id", "version"], "left_anti")
        # versions that no store needs any more go as one folder, others store by store: those of one load
        in_use = {r["version"] for r in held.select("version").distinct().collect()}
        for version in [r["version"] for r in gone.select("version").distinct().collect() if r["version"] not in in_use]:
            delete_folder(self.spark, f"{self.rows_path}/attempt_id={version}")
        for row in gone.where(F.col("version").isin(list(in_use))).collect():
            delete_folder(self.spark, f"{self.rows_path}/attempt_id={row['version']}/store_id={row['store_id']}")
        for attempt in old:
            delete_folder(self.spark, f"{self.manifest_path}/attempt_id={attempt}")

    def _all(self, attempts: list[str]) -> DataFrame:
        rows = read_or_empty(self.spark, self.manifest_path, _MANIFEST, [f"attempt_id={a}" for a in attempts])
        return rows.select("store_id", "version").distinct()
