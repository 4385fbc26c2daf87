"""Run a catalogued query and its SQL and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return str(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    spark_columns, spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    columns, rows = _rows([d[0] for d in result.description], result.fetchall())
    if spark_columns != columns:
        return f"columns {spark_columns} against {columns}"
    if len(spark_rows) != len(rows):
        return f"{len(spark_rows)} rows against {len(rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, rows) if a != b or list(map(type, a)) != list(map(type, b))]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}"
    return None
