from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators import marts
from marketloom.plans import batch
from marketloom.sources import readers, sinks
from marketloom.sources.schemas import LAG_FORECAST_DDL
from marketloom.streaming.landing import landing_stream

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def _write(path, *lines):
    path.write_bytes("\n".join([HEADER, *lines, ""]).encode("latin-1"))
    return str(path)


@pytest.fixture
def database(spark):
    name = f"db_{random.randrange(10**9)}"
    sinks.ensure_database(spark, name)
    yield name
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_csv_keeps_quoted_commas_and_latin1(spark, tmp_path):
    path = _write(
        tmp_path / "a.csv",
        '536365,85123A,"BAG, ""RED""",6,12/1/2010 8:26,2.55,17850,United Kingdom',
        "536366,22633,CAF\xc9,x,12/1/2010 8:28,1.85,,France",
    )
    rows = readers.read_invoices_csv(spark, path, keep_corrupt=True).collect()
    assert rows[0]["Description"] == 'BAG, "RED"' and str(rows[0]["UnitPrice"]) == "2.55"
    assert rows[0]["_corrupt_record"] is None
    assert rows[1]["Description"] == "CAF\xc9" and rows[1]["Quantity"] is None and rows[1]["CustomerID"] is None
    assert rows[1]["_corrupt_record"].startswith("536366")


def test_raw_table_grows_by_appending(spark, database, tmp_path):
    path = _write(tmp_path / "a.csv", "1,A,x,6,12/1/2010 8:26,2.55,17850,France")
    sinks.append_raw(spark, path)
    sinks.append_raw(spark, path)
    assert spark.table("ecommerce_raw").count() == 2
    assert sinks.list_tables(spark) == ["ecommerce_raw"]
    sinks.drop_tables(spark, "ecommerce_raw", "never_there")
    assert sinks.list_tables(spark) == []


def test_overwrite_partitions_and_ctas(spark, database, make_lines):
    sales = make_lines(("1", "A", 1, 5, "u", "2011-01-03"), ("2", "A", 1, 7, "u", "2011-02-10"))
    for _ in range(2):
        sinks.write_table(marts.monthly_sales(sales), "monthly_sales", ["Year", "Month"])
    assert spark.table("monthly_sales").count() == 2
    one = spark.table("monthly_sales").where("Year = 2011 AND Month = 2")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(Year" in one._jdf.queryExecution().toString()
    sinks.ctas_from_view(marts.sales_per_country(sales), "sales_per_country")
    assert spark.table("sales_per_country").count() == 1
    sinks.write_empty_table(spark, "sales_forecast_lags", LAG_FORECAST_DDL)
    assert spark.table("sales_forecast_lags").count() == 0
    counts = readers.row_counts({n: spark.table(n) for n in sinks.list_tables(spark)}).collect()
    assert {r["table_name"]: r["row_count"] for r in counts} == {
        "monthly_sales": 2,
        "sales_per_country": 1,
        "sales_forecast_lags": 0,
    }


def test_csv_sink_has_a_header(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_csv(spark.range(3).withColumn("name", F.lit("a, b")), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["id", "name"] and back.count() == 3 and back.first()["name"] == "a, b"


def test_filter_reaches_the_scan(spark, sample_dir):
    df = spark.read.parquet(f"{sample_dir}/lineitem.parquet")
    plan = readers.table_scan(df, ["l_orderkey"], F.col("l_quantity") > 10)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def _drain(spark, src, dst, checkpoint, **options):
    query = landing_stream(spark, str(src), str(dst), str(checkpoint), once=True, **options)
    assert query.awaitTermination(120)


def test_each_landed_file_is_copied_once(spark, tmp_path):
    src, dst, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    src.mkdir()
    (src / "a.txt").write_text("one\ntwo\n")
    _drain(spark, src, dst, state)
    _drain(spark, src, dst, state)
    (src / "b.txt").write_text("three\n")
    _drain(spark, src, dst, state)
    rows = spark.read.parquet(str(dst)).collect()
    assert sorted(r["value"] for r in rows) == ["one", "three", "two"]
    assert {r["source_file"].rsplit("/", 1)[1] for r in rows} == {"a.txt", "b.txt"}
    for r in rows:
        late = r["arrived_at"] - r["arrived_bucket"]
        assert dt.timedelta(0) <= late < dt.timedelta(minutes=10) and r["arrived_bucket"].minute % 10 == 0
        assert r["arrived_date"] == r["arrived_at"].date()


def test_text_files_roll_by_record_count(spark, tmp_path):
    src, dst, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    src.mkdir()
    (src / "a.txt").write_text("".join(f"line {i}\n" for i in range(25)))
    _drain(spark, src, dst, state, max_records=10, as_text=True)
    files = dst.glob("arrived_date=*/*.txt")
    assert sorted(len(f.read_text().splitlines()) for f in files) == [5, 10, 10]


def test_files_roll_by_size(spark, tmp_path):
    src, dst, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    src.mkdir()
    for k in range(4):
        (src / f"{k}.txt").write_text("x" * 99 + "\n")
    _drain(spark, src, dst, state, max_bytes=200, as_text=True)
    sizes = [f.stat().st_size for f in dst.glob("arrived_date=*/*.txt")]
    assert sum(sizes) == 400 and max(sizes) <= 200 and len(sizes) >= 2


def test_batch_run_writes_every_table(spark, database, tmp_path):
    rng = random.Random(4)
    lines = []
    for invoice in range(600):
        day = dt.datetime(2010, 12, 1, 9, 5) + dt.timedelta(days=rng.randrange(420), minutes=rng.randrange(600))
        customer = rng.choice(["", *[str(17000 + i) for i in range(60)]])
        for _ in range(rng.randint(1, 5)):
            p = rng.randrange(25)
            lines.append(
                f'{536000 + invoice},P{p},"ITEM, {p}",{rng.randint(-1, 30)},'
                f"{day.month}/{day.day}/{day.year} {day.hour}:{day.minute:02d},{1 + p * 0.25:.2f},{customer},"
                f"{rng.choice(['United Kingdom', 'France', 'Spain'])}"
            )
    path = _write(tmp_path / "data.csv", *lines)
    report = batch.run(
        spark, path, database, min_support=0.02, min_confidence=0.05, rule_confidence=0.05, trees=3, rounds=2,
        restarts=2, horizon_days=30,
    )
    counts = {r["table_name"]: r["row_count"] for r in report.collect()}
    assert set(counts) == {batch.RAW, batch.CLEAN, *batch.STEPS}
    assert counts[batch.RAW] == len(lines) > counts[batch.CLEAN] > 0
    assert all(n > 0 for n in counts.values()), counts
    assert counts["sales_forecast_detailed"] == 30 and counts["customer_segments"] == 60
    assert set(sinks.list_tables(spark)) == set(counts)


def test_loading_again_changes_nothing_and_a_second_file_only_adds(spark, database, tmp_path):
    first = _write(tmp_path / "a.csv", "1,A,x,6,12/1/2010 8:26,2.50,17850,France", "1,B,y,1,1/2/2011 8:26,1.00,17850,France")
    second = _write(tmp_path / "b.csv", "2,A,x,2,1/5/2011 9:00,2.50,17851,Spain", "3,A,x,-1,1/5/2011 9:00,2.50,,Spain")
    for path in (first, first, second, first):
        batch.load(spark, path)
    raw = sorted((r["InvoiceNo"], r["StockCode"]) for r in spark.table(batch.RAW).collect())
    assert raw == [("1", "A"), ("1", "B"), ("2", "A"), ("3", "A")]
    clean = spark.table(batch.CLEAN)
    assert sorted((r["InvoiceNo"], r["Year"], r["Month"]) for r in clean.collect()) == [("1", 2010, 12), ("1", 2011, 1), ("2", 2011, 1)]
    folders = {f.split(batch.CLEAN)[1].rpartition("/")[0] for f in clean.inputFiles()}
    assert len(folders) == 3
