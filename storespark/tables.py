"""The set of tables a query runs on."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from storespark.schemas import TABLES


class Tables(Mapping[str, DataFrame]):
    """Maps table names to DataFrames; a value may be a function that builds its frame on first use."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if not isinstance(frame, DataFrame) and callable(frame):
            frame = self._frames[name] = frame()
        return frame

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as missing:
            raise AttributeError(f"no table {name!r}") from missing

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def replaced(self, **frames: DataFrame | Callable[[], DataFrame]) -> Tables:
        return Tables({**self._frames, **frames})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: list[str] | None = None) -> Tables:
        """Tables stored as ``<root>/<name>``, read with the declared schema."""
        wanted = names or list(TABLES)
        return cls({n: (lambda n=n: spark.read.schema(TABLES[n]).parquet(f"{root}/{n}")) for n in wanted})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names: list[str] | None = None) -> Tables:
        wanted = names or list(TABLES)
        return cls({n: (lambda n=n: spark.table(f"{database}.{n}")) for n in wanted})
