"""Hand-made rows with known answers."""

from __future__ import annotations

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.functions import columns as c
from marketloom.operators import anomalies, churn, cleaning, evaluation, marts, reports, rfm, series


def test_returns_and_free_items_are_dropped_and_guests_kept(make_lines):
    lines = make_lines(
        ("1", "A", -1, 5, "u", "2011-01-01"),
        ("2", "A", 3, 0, "u", "2011-01-01"),
        ("3", "A", 2, 5, None, "2011-01-01"),
        ("4", "A", 1, 5, "u", "2011-01-01"),
    )
    assert {r["InvoiceNo"] for r in cleaning.valid_sales(lines).collect()} == {"3", "4"}
    assert {r["InvoiceNo"] for r in cleaning.valid_customer_sales(lines).collect()} == {"4"}
    sales = cleaning.valid_sales(lines)
    assert marts.sales_per_country(sales).first()["TotalSales"] == Decimal("15.00")


def test_bad_dates_and_bad_customer_ids_become_null(spark):
    df = spark.createDataFrame([("12/1/2010 8:26", "17850"), ("zz", "17850x")], "InvoiceDate STRING, c STRING")
    rows = cleaning.parse_invoice_date(df).withColumn("n", F.expr("try_cast(c AS INT)")).collect()
    assert rows[0]["InvoiceDate"] == dt.datetime(2010, 12, 1, 8, 26) and rows[0]["n"] == 17850
    assert rows[1]["InvoiceDate"] is None and rows[1]["n"] is None


def test_no_country_means_no_filter_and_last_day_is_whole(make_lines):
    lines = make_lines(
        ("1", "A", 1, 5, "u", "2011-01-01T10:00", "x", "France"),
        ("2", "A", 1, 5, "u", "2011-01-03T23:30", "x", "Spain"),
        ("3", "A", 1, 5, "u", "2011-01-04T00:00", "x", "Spain"),
    )
    end = dt.date(2011, 1, 3)
    assert cleaning.filter_sales(lines, [], None, end).count() == 2
    assert cleaning.filter_sales(lines, ["Spain"], None, end).count() == 1
    assert cleaning.filter_sales(lines, ["Spain"], dt.date(2011, 1, 4)).count() == 1


def test_every_score_triple_lands_in_its_segment(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "R_Score INT, F_Score INT, M_Score INT")
    tenths = rfm.score_tenths()
    rows = df.select("*", tenths.alias("t"), rfm.segment(tenths).alias("s"), rfm.churn_risk().alias("k")).collect()
    floors = list(zip(rfm.SEGMENT_FLOORS, rfm.SEGMENT_NAMES))
    for r in rows:
        exact = 3 * r["R_Score"] + 3 * r["F_Score"] + 4 * r["M_Score"]
        assert r["t"] == exact
        assert r["s"] == next((name for floor, name in floors if exact >= floor), "Lost")
        assert r["k"] == ("High" if r["R_Score"] <= 2 else "Medium" if r["R_Score"] == 3 else "Low")
    edges = {(r["R_Score"], r["F_Score"], r["M_Score"]): r["s"] for r in rows}
    assert edges[(3, 4, 1)] == edges[(4, 3, 1)] == "Promising"


def test_calendar_days_and_elapsed_days_differ(spark):
    a, b = dt.datetime(2011, 1, 1, 18), dt.datetime(2011, 1, 2, 14)
    row = spark.createDataFrame([(a, b)], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ").select(
        c.calendar_days("a", "b").alias("calendar"), c.elapsed_days("a", "b").alias("elapsed")
    ).first()
    assert (row["calendar"], row["elapsed"]) == (1, 0)


def test_churn_features_by_hand(make_lines):
    lines = make_lines(
        # one line
        ("1", "A", 1, 10, "one", "2011-01-01"),
        # one invoice, two lines
        ("2", "A", 1, 10, "two", "2011-02-01"),
        ("2", "B", 1, 20, "two", "2011-02-01"),
        # three invoices, then back in the observation
        ("3", "A", 1, 10, "back", "2011-01-01", "x", "United Kingdom"),
        ("4", "A", 2, 10, "back", "2011-01-11", "x", "France"),
        ("5", "C", 3, 10, "back", "2011-01-31T12:00", "x", "France"),
        ("6", "A", 1, 10, "back", "2011-06-01", "x", "France"),
    )
    rows = {r["CustomerID"]: r for r in churn.churn_features(lines).collect()}
    cut = dt.datetime(2011, 5, 2)
    one, two, back = rows["one"], rows["two"], rows["back"]
    assert one["AvgDaysBetween"] == one["TenureDays"] == (cut - dt.datetime(2011, 1, 1)).days
    assert one["PurchaseVariability"] == 0 and one["Churned"] == 1
    assert two["AvgDaysBetween"] == 0 and two["Frequency"] == 2 and two["ProductDiversity"] == 2
    assert back["AvgDaysBetween"] == 15.0 and back["Frequency"] == 3 and back["Churned"] == 0
    assert back["PurchaseVariability"] == pytest.approx(10.0)
    assert back["Recency"] == 90 and back["IsUK"] == 1
    # The 90 days before the cut start 2011-02-01.
    assert (one["Transactions90d"], two["Transactions90d"], back["Transactions90d"]) == (0, 2, 0)


def test_constant_measure_gives_no_anomaly(make_lines):
    sales = make_lines(*[(str(i), "A", 1 if i else 100, 5, "u", "2011-01-01") for i in range(30)])
    rows = anomalies.anomalies(sales).collect()
    assert all(r["price_zscore"] == 0 for r in rows)
    flagged = [r for r in rows if r["is_anomaly"]]
    assert [r["InvoiceNo"] for r in flagged] == ["0"]
    assert flagged[0]["anomaly_type"] == "High Quantity"
    assert flagged[0]["severity"] == "Medium"
    rate = anomalies.anomaly_rate(anomalies.anomalies(sales)).first()
    assert (rate["total_transactions"], rate["anomalies"]) == (30, 1)


def test_anomaly_rate_of_nothing(make_lines):
    nothing = anomalies.anomalies(make_lines(("1", "A", 1, 5, "u", "2011-01-01")).where("Quantity > 5"))
    assert tuple(anomalies.anomaly_rate(nothing).first()) == (0, 0, 0.0)


def test_recency_bins_keep_both_ends(spark):
    rows = [(0, 0.1), (30, 0.3), (31, 0.5), (90, 0.7), (400, 0.9)]
    df = spark.createDataFrame(rows, "Recency INT, ChurnRisk DOUBLE")
    found = {r["RecencyBin"]: r for r in churn.churn_by_recency_bin(df).collect()}
    assert {k: r["Customers"] for k, r in found.items()} == {"0-30d": 2, "30-60d": 1, "60-90d": 1, "90d+": 1}
    assert found["0-30d"]["AvgChurnRiskPct"] == pytest.approx(20.0)


def test_risk_level_counts_zero_as_low(spark):
    rows = [(0.0,), (0.3,), (0.31,), (0.6,), (0.61,), (1.0,)]
    levels = spark.createDataFrame(rows, "ChurnRisk DOUBLE").select(churn.risk_level().alias("l")).collect()
    assert [r["l"] for r in levels] == ["Low", "Low", "Medium", "Medium", "High", "High"]


def test_fill_missing(spark):
    rows = [(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (2.5,)]
    df = cleaning.fill_missing(spark.createDataFrame(rows, "v DOUBLE"), "v")
    assert [r["v"] for r in df.collect()] == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_text_helpers(spark):
    row = spark.range(1).select(
        c.first_word(F.lit("  red  bag ")).alias("a"),
        c.first_word(F.lit(None).cast("string")).alias("b"),
        c.first_word(F.lit("  ")).alias("c"),
        c.percent_text(F.lit(0.1234)).alias("d"),
        c.year_month_label(F.lit(2011), F.lit(3)).alias("e"),
        c.pair_label(F.lit("x" * 40), F.lit("y")).alias("f"),
        c.percent_change(F.lit(0), F.lit(5)).alias("g"),
    ).first()
    assert tuple(row)[:5] == ("red", "Unknown", "Unknown", "12.34%", "2011-03")
    assert row["f"] == "x" * 30 + " + y"
    assert row["g"] is None


def test_histogram_and_shares_sum_to_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    bins = {r["bin"]: r["count"] for r in reports.score_histogram(df, "v", 20).collect()}
    assert sum(bins.values()) == 1000 and set(bins) <= set(range(1, 21)) and 20 in bins
    same = reports.score_histogram(df.withColumn("v", F.lit(1.0)), "v", 20).collect()
    assert [tuple(r) for r in same] == [(1, 1000)]
    shares = reports.distribution_pct(df, "v").agg(F.sum("pct"), F.sum("count")).first()
    assert shares[0] == pytest.approx(100.0) and shares[1] == 1000


def test_top_k_per_key_ships_k_rows_per_task(spark):
    key = F.when(F.col("id") >= 5, "hot").otherwise("cold")
    best = reports.top_k_per_key(spark.range(1000).select(key.alias("k"), "id"), ["k"], [F.col("id").desc()], 3)
    assert sorted(r["id"] for r in best.collect()) == [2, 3, 4, 997, 998, 999]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_absent_week_days_stay(make_lines):
    sales = make_lines(("1", "A", 1, 5, "u", "2011-01-03"), ("2", "A", 1, 7, "u", "2011-01-10"))
    rows = marts.revenue_by_day_of_week(sales).orderBy("DayIndex").collect()
    assert [r["DayOfWeek"] for r in rows] == c.WEEKDAYS
    assert rows[0]["Revenue"] == Decimal("12.00") and all(r["Revenue"] is None for r in rows[1:])


def test_series_helpers(spark):
    months = [(2010, 11, 10), (2010, 12, 20), (2011, 1, 60)]
    monthly = spark.createDataFrame(months, "Year INT, Month INT, MonthlySales INT")
    order = ["Year", "Month"]
    future = series.future_months(monthly).orderBy(*order).collect()
    assert [tuple(r) for r in future] == [(2011, 2), (2011, 3), (2011, 4)]
    assert series.trend_slope(monthly, "MonthlySales", 6, order).first()["slope"] == pytest.approx(25.0)
    growth = series.month_growth(monthly, "MonthlySales", 6, order).first()["growth_pct"]
    assert growth == pytest.approx(25 / 30 * 100)
    assert series.last_row(monthly, order).first()["MonthlySales"] == 60
    full = series.moving_avg(monthly, "MonthlySales", "m", -2, 0, full=True, order=order)
    assert [r["m"] for r in full.orderBy(*order).collect()] == [None, None, 30.0]
    assert series.future_months(monthly.where("Year > 2020")).count() == 0


def test_error_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (None, 5.0)], "a DOUBLE, p DOUBLE")
    row = evaluation.mape_rmse_mae(df, "a", "p").first()
    assert row["mape"] == pytest.approx(10.0) and row["mae"] == pytest.approx(15.0)
    assert row["rmse"] == pytest.approx((500 / 2) ** 0.5)
    assert row["model_accuracy"] == pytest.approx(90.0)


def test_class_report(spark):
    rows = [(1, 1.0)] * 3 + [(1, 0.0)] + [(0, 0.0)] * 4 + [(0, 1.0)] * 2
    df = spark.createDataFrame(rows, "y INT, p DOUBLE")
    report = {r["class"]: r for r in evaluation.class_report(df, "y", "p").collect()}
    assert report[1]["precision"] == pytest.approx(3 / 5) and report[1]["recall"] == pytest.approx(3 / 4)
    assert report[1]["f1"] == pytest.approx(2 / 3) and report[1]["support"] == 4
    assert report[0]["precision"] == pytest.approx(4 / 5) and report[0]["support"] == 6
