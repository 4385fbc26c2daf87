from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.functions.keys import dense_ids, hash_position, train_test_split
from marketloom.functions.quantiles import column_quantiles, exact_quantiles

PROBS = [0.0, 0.2, 0.25, 0.5, 0.8, 0.99, 1.0]


def _check(df, key_values, buckets):
    found = {r["k"]: r for r in exact_quantiles(df, "v", PROBS, ["k"], buckets).collect()}
    assert set(found) == set(key_values)
    for key, values in key_values.items():
        assert found[key]["n"] == len(values)
        assert found[key]["quantiles"] == pytest.approx(list(np.quantile(values, PROBS)), abs=1e-9)


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_equals_numpy_for_skewed_and_repeated_values(spark, buckets):
    rng = np.random.default_rng(7)
    groups = {
        "lognormal": rng.lognormal(3, 2, 700).round(2).tolist(),
        "few values": rng.integers(0, 4, 500).astype(float).tolist(),
        "hot value": [5.0] * 400 + rng.normal(5, 1, 200).tolist(),
        "one row": [3.5],
        "negative": (-rng.exponential(10, 301)).tolist(),
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    _check(spark.createDataFrame(rows, "k STRING, v DOUBLE"), groups, buckets)


def test_null_key_and_null_values(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", None), ("a", 2.0)]
    _check(spark.createDataFrame(rows, "k STRING, v DOUBLE"), {None: [1.0, 3.0], "a": [2.0]}, 8)


def test_without_keys_and_empty(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert exact_quantiles(df, "v", [0.5, 0.905]).first()["quantiles"] == pytest.approx([50.0, 90.5])
    nothing = exact_quantiles(df.where("v < 0"), "v", [0.5]).first()
    assert nothing["quantiles"] == [None] and nothing["n"] is None


def test_dense_ids_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("p"), F.col("id") % 1700).alias("code"))
    first = {r["code"]: r["n"] for r in dense_ids(df, "code", "n", 64).collect()}
    again = {r["code"]: r["n"] for r in dense_ids(df.repartition(13), "code", "n", 64).collect()}
    assert sorted(first.values()) == list(range(1700))
    assert first == again


def test_split_is_repeatable_and_close_to_its_share(spark):
    df = spark.range(20000)
    train, test = train_test_split(df, ["id"])
    assert train.count() + test.count() == 20000
    assert 0.78 < train.count() / 20000 < 0.82
    moved = train_test_split(df.repartition(7), ["id"])[0]
    assert moved.exceptAll(train).count() == 0
    assert df.agg(F.min(hash_position(["id"]))).first()[0] >= 0


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_columns_at_once_equal_numpy(spark, buckets):
    rng = np.random.default_rng(3)
    columns = {
        "a": rng.lognormal(3, 2, 900).round(2).tolist(),
        "b": [5.0] * 600 + rng.normal(5, 1, 300).tolist(),
        "c": [None if i % 3 else float(i) for i in range(900)],
        "d": [None] * 900,
        "e": [None] * 899 + [2.5],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(5)
    probs = [0.0, 0.2, 0.4, 0.505, 0.8, 1.0]
    found = spark.range(1).select(column_quantiles(df, list(columns), probs, buckets).alias("q")).first()["q"]
    for name, values in columns.items():
        kept = [v for v in values if v is not None]
        wanted = np.quantile(kept, probs).tolist() if kept else [None] * len(probs)
        assert found[name] == pytest.approx(wanted), name


def test_quintile_scores_shuffle_nothing_by_metric(spark, sample_dir):
    from marketloom.plans.catalog import all_queries

    plan = all_queries()["rfm_quintile"](spark, sample_dir)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(Metric" not in plan and "Join" not in plan
