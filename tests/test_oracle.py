"""Every catalogued query with SQL agrees with an independent engine on the sample tables."""

from __future__ import annotations

import compare
import pytest

from marketloom.plans.catalog import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def connection(sample_dir):
    return compare.connect(sample_dir)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_agrees(spark, sample_dir, connection, name):
    query = QUERIES[name]
    assert compare.difference(query(spark, sample_dir), connection, query.sql) is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is None])
def test_has_rows(spark, sample_dir, name):
    df = QUERIES[name](spark, sample_dir)
    assert len(set(df.columns)) == len(df.columns)
    assert df.limit(1).count() == 1


def test_entry(spark, sample_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
