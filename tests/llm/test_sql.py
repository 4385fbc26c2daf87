"""Registered queries agree with their check SQL."""

from __future__ import annotations

from pathlib import Path

import compare
import duckdb
import pytest

from marketloom.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_agrees(spark, sample_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{Path(sample_dir) / table}.parquet')")
    assert compare.difference(catalog.QUERIES[name](spark, sample_dir), connection, catalog.SQL[name]) is None
