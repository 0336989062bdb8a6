"""Compare registered queries with their SQL twins on a second engine."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, (float, Decimal)):
        return None if math.isnan(value) else round(float(value), 6)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both sides agree, otherwise what differs first."""
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    expected = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"row {a} != {e}"
    return None
