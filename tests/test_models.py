"""Fitted models: shapes, ranges, repeatability, and better than guessing."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import churn, evaluation, forecast, recommend, rfm, segments, series
from marketloom.plans.catalog import all_queries
from marketloom.sources.samples import Tables


@pytest.fixture(scope="module")
def tables(spark, sample_dir):
    return Tables(spark, sample_dir)


@pytest.fixture(scope="module")
def months(spark):
    """Forty months with trend, a yearly wave and noise."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(40):
        year, month = 2010 + i // 12, i % 12 + 1
        revenue = 1000.0 + 20 * i + 150 * math.sin(2 * math.pi * month / 12) + float(rng.normal(0, 40))
        rows.append((year, month, revenue, 50 + i, 100 + 2 * i))
    return spark.createDataFrame(
        rows, "year INT, month INT, total_revenue DOUBLE, unique_customers INT, total_orders INT"
    )


@pytest.fixture(scope="module")
def days(spark):
    start = dt.date(2010, 1, 1)
    rng = np.random.default_rng(3)
    rows = [
        (start + dt.timedelta(days=i), 500 + i * 0.5 + 80 * math.sin(2 * math.pi * i / 7) + rng.normal(0, 5))
        for i in range(500)
    ]
    return spark.createDataFrame([(d, float(v)) for d, v in rows], "Date DATE, Revenue DOUBLE")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centres = [(100, 4, 120), (150, 20, 40), (3000, 2, 40), (5000, 40, 40)]
    rows = [
        (f"c{j}-{i}", float(max(x + rng.normal(0, 10), 1)), y)
        for j, (x, y, n) in enumerate(centres)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "CustomerID STRING, TotalSpending DOUBLE, TotalOrders BIGINT")
    return df.withColumns(
        {"TotalItems": F.col("TotalOrders") * 3, "AvgOrderValue": F.col("TotalSpending") / F.col("TotalOrders")}
    )


def test_clusters_find_the_blobs_and_get_their_names(blobs):
    found = segments.customer_segments(blobs)
    rows = found.withColumn("blob", F.split("CustomerID", "-")[0]).select("blob", "Cluster").distinct()
    assert rows.count() == 4
    named = {r["b"]: r["Segment"] for r in segments.segment_names(found).select(
        F.split("CustomerID", "-")[0].alias("b"), "Segment").distinct().collect()}
    assert named["c3"] == "High Value Frequent" and named["c0"] == "Low Engagement"
    assert named["c1"] == "Regular Shoppers" and named["c2"] == "High Value Occasional"
    ranked = {r["b"]: r["SegmentName"] for r in segments.segment_rank_names(found).select(
        F.split("CustomerID", "-")[0].alias("b"), "SegmentName").distinct().collect()}
    assert [ranked[f"c{i}"] for i in (3, 2, 1, 0)] == segments.RANK_NAMES
    assert segments.segment_metrics(segments.segment_names(found)).agg(F.sum("Customers")).first()[0] == 240


def test_each_fit_of_clusters_holds_its_own_vectors(spark, blobs, monkeypatch):
    levels, fit = [], segments.KMeans.fit
    monkeypatch.setattr(segments.KMeans, "fit", lambda self, rows: (levels.append(rows.storageLevel), fit(self, rows))[1])
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    assert segments.customer_segments(blobs, restarts=3).count() == 240
    # Rows that somebody else holds would be decoded again in every pass.
    assert len(levels) == 3 and not any(level.useMemory or level.useDisk for level in levels)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_cluster_profile_and_box_stats(blobs):
    found = segments.customer_segments(blobs, restarts=2)
    assert segments.cluster_profile(found).count() == 240
    stats = rfm.box_stats(found, "Cluster", "TotalSpending").collect()
    assert len(stats) == 4
    assert all(r["Min"] <= r["Q1"] <= r["Median"] <= r["Q3"] <= r["Max"] for r in stats)


def _lifecycle(spark, n=400):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        gone = i % 3 == 0
        lines = int(rng.integers(1, 6) if gone else rng.integers(4, 40))
        rows.append((f"c{i}", int(rng.integers(100, 300) if gone else rng.integers(0, 90)), lines,
                     float(lines * 10), 10.0, int(lines * 5)))
    return spark.createDataFrame(
        rows,
        "CustomerID STRING, Recency INT, TotalTransactions BIGINT, TotalSpent DOUBLE, AvgOrderValue DOUBLE, "
        "CustomerLifetime INT",
    )


def test_forest_beats_guessing_and_repeats(spark):
    lifecycle = _lifecycle(spark)
    first = churn.churn_rf(lifecycle, trees=10, depth=4)
    scores = {r["metric"]: r["value"] for r in evaluation.binary_metrics(
        first.holdout, "Churn", "ChurnPrediction").collect()}
    assert scores["auc"] > 0.8 and 0 <= scores["precision"] <= 1 and scores["accuracy"] > 0.67
    rows = churn.rf_output(first.predictions).collect()
    assert len(rows) == 400
    for r in rows:
        wanted = "High Risk" if r["ChurnRisk"] >= 0.7 else "Medium Risk" if r["ChurnRisk"] >= 0.4 else "Low Risk"
        assert r["RiskCategory"] == wanted and 0 <= r["ChurnRisk"] <= 1
    weights = first.feature_importance().collect()
    assert "Recency" not in {r["Feature"] for r in weights}
    assert sum(r["Importance"] for r in weights) == pytest.approx(1.0)
    assert "Recency" in churn.churn_rf(lifecycle, trees=2, depth=2, use_recency=True).features


def test_boosted_trees(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        gone = int(i % 4 != 0)
        values = [float(v) for v in rng.normal(gone * 2, 1, len(churn.GBT_FEATURES))]
        rows.append((f"c{i}", *values, gone))
    ddl = "CustomerID STRING, " + ", ".join(f"{n} DOUBLE" for n in churn.GBT_FEATURES) + ", Churned INT"
    fitted = churn.churn_gbt(spark.createDataFrame(rows, ddl), rounds=5, depth=3)
    report = {r["class"]: r for r in evaluation.class_report(
        fitted.holdout, "Churned", "ChurnPrediction").collect()}
    assert report[1]["recall"] > 0.7 and report[0]["recall"] > 0.7
    assert fitted.predictions.count() == 300
    weights = [r["Importance"] for r in fitted.feature_importance().collect()]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1.0)
    summary = churn.risk_summary(fitted.predictions).collect()
    assert sum(r["customer_count"] for r in summary) == 300
    order = [churn.RISK_ORDER.index(r["ChurnRiskLevel"]) for r in summary]
    assert order == sorted(order)
    ends = churn.churn_extremes(churn.gbt_output(fitted.predictions), 3, 2).collect()
    worst = [r["ChurnRisk"] for r in ends if r["Side"] == "Highest risk"]
    best = [r["ChurnRisk"] for r in ends if r["Side"] == "Most loyal"]
    assert len(worst) == 3 and len(best) == 2 and min(worst) >= max(best)


def test_churn_features_split_and_extremes_read_stored_rows(spark, make_lines):
    lines = make_lines(
        ("1", "A", 1, 5, "u", "2011-01-01"),
        ("2", "B", 2, 5, "u", "2011-01-11"),
        ("3", "A", 1, 5, "v", "2011-01-05"),
        ("4", "A", 1, 5, "v", "2011-03-01"),
    )
    found = churn.churn_features(lines, days=30, home="France")
    assert found.inputFiles()  # the lines themselves have no files
    rows = {r["CustomerID"]: (r["Frequency"], r["ProductDiversity"], r["AvgDaysBetween"], r["Churned"]) for r in found.collect()}
    assert rows == {"u": (2, 2, 10.0, 1), "v": (1, 1, 25.0, 0)}
    scores = spark.createDataFrame([(f"c{i}", i / 10) for i in range(10)], "CustomerID STRING, ChurnRisk DOUBLE")
    ends = churn.churn_extremes(scores, 2, 1)
    assert ends.inputFiles() and [r["CustomerID"] for r in ends.collect()] == ["c9", "c8", "c0"]
    flagged = scores.withColumn("y", (F.col("ChurnRisk") > 0.4).cast("int"))
    assert all(side.inputFiles() for side in churn.stratified_split(flagged, "y", ["CustomerID"]))


def test_stratified_split_keeps_class_shares(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    train, test = churn.stratified_split(df, "y", ["k"])
    shares = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    assert shares == {0: 720, 1: 80}
    assert train.count() + test.count() == 1000
    assert train.intersect(test).count() == 0


def test_lag_model(months):
    rows = forecast.forecast_lr_lags(months).orderBy("year", "month").collect()
    assert len(rows) == 37
    for r in rows:
        assert r["forecast_lower"] <= r["forecasted_revenue"] <= r["forecast_upper"]
        assert r["accuracy"] > 80


def test_lag_model_needs_more_than_three_rows(months):
    short = months.where("year = 2010 AND month <= 6")
    found = forecast.forecast_lr_lags(short)
    assert found.count() == 0 and "accuracy" in found.columns
    assert forecast.forecast_lr_recursive(short).count() == 0


def test_index_model(months):
    monthly = months.select(
        F.col("year").alias("Year"), F.col("month").alias("Month"), F.col("total_revenue").alias("MonthlySales")
    )
    rows = forecast.forecast_lr_index(monthly).orderBy("Year", "Month").collect()
    ahead = [r for r in rows if r["Type"] == "Forecast"]
    assert len(rows) == 43 and [(r["Year"], r["Month"]) for r in ahead] == [(2013, 5), (2013, 6), (2013, 7)]
    assert all(r["ActualSales"] is None and 1000 < r["PredictedSales"] < 3000 for r in ahead)
    chart = forecast.dashboard_series(monthly).collect()
    assert len(chart) == 15


def test_recursive_model_by_hand(months):
    rows = {r["YearMonth"]: r for r in forecast.forecast_lr_recursive(months).collect()}
    ahead = [rows[f"2013-{m:02d}"] for m in (5, 6, 7)]
    assert all(r["Type"] == "Forecast" and r["Revenue"] is None for r in ahead)
    # The same regression and recursion with numpy.
    y = np.array([r["total_revenue"] for r in months.orderBy("year", "month").collect()])
    x = np.array([[i, y[i - 1], y[i - 2], y[i - 3 : i].mean(), 1] for i in range(3, 40)])
    w, *_ = np.linalg.lstsq(x, y[3:], rcond=None)
    slope = np.polyfit(range(34, 40), y[-6:], 1)[0]
    f1 = np.dot([40, y[-1], y[-2], y[-3:].mean(), 1], w) + slope * 0.7
    f2 = np.dot([41, f1, y[-1], np.mean([y[-1], f1]), 1], w) + slope * 1.4
    f3 = np.dot([42, f2, f1, np.mean([y[-1], f1, f2]), 1], w) + slope * 2.1
    assert [r["Predicted_Revenue"] for r in ahead] == pytest.approx([f1, f2, f3], rel=1e-3)
    kpis = evaluation.forecast_kpis(forecast.forecast_lr_recursive(months)).first()
    assert kpis["last_actual"] == pytest.approx(y[-1]) and kpis["total_forecast"] == pytest.approx(f1 + f2 + f3, rel=1e-3)


def test_recursive_model_stays_at_or_above_zero(months):
    falling = months.withColumn("total_revenue", F.greatest(F.lit(4000) - F.col("total_revenue") * 2, F.lit(1.0)))
    assert all(r["Predicted_Revenue"] >= 0 for r in forecast.forecast_lr_recursive(falling).where(
        "Type = 'Forecast'").collect())


def test_seasonal_model(days):
    rows = forecast.forecast_seasonal(days, 30).orderBy("Date").collect()
    past = [r for r in rows if r["Type"] == "Historical"]
    ahead = [r for r in rows if r["Type"] == "Forecast"]
    assert len(past) == 500 and len(ahead) == 30
    assert all(r["Lower_Bound"] <= r["Predicted_Revenue"] <= r["Upper_Bound"] for r in rows)
    error = np.mean([abs(r["Revenue"] - r["Predicted_Revenue"]) for r in past])
    spread = np.std([r["Revenue"] for r in past])
    assert error < spread / 5
    inside = np.mean([r["Lower_Bound"] <= r["Revenue"] <= r["Upper_Bound"] for r in past])
    assert inside > 0.9
    widths = [r["Confidence_Interval"] for r in ahead]
    assert all(a < b for a, b in zip(widths, widths[1:], strict=False)) and widths[0] >= past[-1]["Confidence_Interval"]


def test_one_group_equals_the_single_series_model(days):
    alone = {r["Date"]: r for r in forecast.forecast_seasonal(days, 20).where("Type = 'Forecast'").collect()}
    grouped = forecast.forecast_per_group(days.withColumn("k", F.lit("a")), "k", 20).collect()
    assert len(grouped) == 20
    for r in grouped:
        # MLlib scales by the sample deviation of the label too, so the penalty differs a little.
        assert r["Revenue"] == pytest.approx(alone[r["Date"]]["Predicted_Revenue"], rel=0.05)
        assert r["Lower_Bound"] <= r["Revenue"] <= r["Upper_Bound"]


def test_monthly_roll_up(days, make_lines):
    daily = forecast.forecast_seasonal(days, 30)
    lines = make_lines(
        ("1", "A", 2, 5, "u", "2010-01-01"), ("1", "B", 1, 5, "u", "2010-01-01"), ("2", "B", 1, 5, "v", "2010-01-09")
    )
    rolled = series.monthly_from_daily(daily, lines).collect()
    january = next(r for r in rolled if r["YearMonth"] == "2010-01")
    assert (january["Orders"], january["Customers"], january["ItemsSold"]) == (3, 2, 4)
    # The month in which history ends appears with both types.
    assert {r["Type"] for r in rolled if r["YearMonth"] == "2011-05"} == {"Historical", "Forecast"}


def test_als(spark):
    rows = [(f"u{u}", f"p{p}", 5.0 if (u % 2) == (p % 2) else 1.0) for u in range(12) for p in range(8) if (u + p) % 5]
    ratings = spark.createDataFrame(rows, "CustomerID STRING, StockCode STRING, rating DOUBLE")
    names = spark.createDataFrame([(f"p{p}", f"name {p}") for p in range(8)], "StockCode STRING, Description STRING")
    recs = recommend.als_recommendations(ratings, names, k=3, rank=4).collect()
    assert len(recs) == 36 and all(r["Description"] == f"name {r['ProductStockCode'][1:]}" for r in recs)
    liked = [int(r["CustomerID"][1:]) % 2 == int(r["ProductStockCode"][1:]) % 2 for r in recs]
    assert np.mean(liked) > 0.9


def test_forecast_queries_have_both_types(spark, sample_dir):
    rows = all_queries()["forecast_lr_index"](spark, sample_dir).groupBy("Type").count().collect()
    assert {r["Type"] for r in rows} == {"Historical", "Forecast"}
    assert next(r["count"] for r in rows if r["Type"] == "Forecast") == 3


def test_sample_rf_predicts_every_customer(tables):
    model = churn.churn_rf(churn.customer_lifecycle(tables.sales), trees=3, depth=3)
    known = tables.sales.where("CustomerID IS NOT NULL").select("CustomerID").distinct().count()
    assert model.predictions.count() == known


@pytest.mark.parametrize("block", [16, 64, 8192])
def test_top_items_are_those_of_all_products(spark, block):
    rng = np.random.default_rng(3)
    mine, theirs = rng.random((70, 6), dtype=np.float32), rng.random((300, 6), dtype=np.float32) ** 2
    mine[5] = 0
    tables = [
        spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id INT, features ARRAY<FLOAT>")
        for m in (mine, theirs)
    ]
    rows = recommend.top_items(*tables, 4, block).collect()
    scores = mine @ theirs.T
    assert len(rows) == 70 * 4 == len({(r["user"], r["item"]) for r in rows})
    found = {u: sorted((r["rating"] for r in rows if r["user"] == u), reverse=True) for u in range(70)}
    assert all(found[u] == pytest.approx(sorted(scores[u])[:-5:-1], rel=1e-5) for u in range(70))
    assert all(r["rating"] == pytest.approx(scores[r["user"], r["item"]], rel=1e-5) for r in rows)
