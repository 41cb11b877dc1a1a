"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from rowloom.plans.registry import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    """A value as both engines print it: no decimals, no dates as timestamps."""
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return f"{type(value).__name__} {value}"


def bag(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, function, sql: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    result = function(spark, folder)
    got = bag(result.columns, result.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = bag(names, cursor.fetchall())
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} and {b}"
    return None
