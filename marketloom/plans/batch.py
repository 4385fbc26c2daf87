"""The batch run: land a file, clean it, and write every table in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import (
    anomalies,
    baskets,
    churn,
    cleaning,
    forecast,
    marts,
    recommend,
    rfm,
    segments,
    series,
    similarity,
)
from marketloom.session import drop_stored, prepare, stored
from marketloom.sources import sinks
from marketloom.sources.readers import read_invoices_csv, row_counts

RAW, CLEAN = "ecommerce_raw", "ecommerce_transformed"
DATABASE = "ecommerce_db"
#: Column of the file a line came from.
SOURCE = "SourceFile"

Step = Callable[[DataFrame, Mapping[str, Any]], DataFrame]


def _customers(sales: DataFrame) -> DataFrame:
    return cleaning.valid_customer_sales(sales)


def _once(o: Mapping[str, Any], name: str, fit: Callable[[], Any]) -> Any:
    """A fit that several tables of one run share."""
    if name not in o["fits"]:
        o["fits"][name] = fit()
    return o["fits"][name]


def _mined(sales: DataFrame, o: Mapping[str, Any]):
    return _once(
        o, "itemsets", lambda: baskets.frequent_itemsets(sales, o["min_support"], o["min_confidence"])
    )


def _rules(sales: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    return baskets.association_rules(_mined(sales, o), o["rule_confidence"])


def _itemsets(sales: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    return _mined(sales, o).freqItemsets


def _forest(sales: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    return churn.rf_output(churn.churn_rf(churn.customer_lifecycle(sales), trees=o["trees"]).predictions)


def _boosted(sales: DataFrame, o: Mapping[str, Any]) -> churn.ChurnModel:
    return _once(
        o,
        "boosted",
        lambda: churn.churn_gbt(churn.churn_features(_customers(sales), home=o["home"]), rounds=o["rounds"]),
    )


def _clustered(sales: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    return _once(
        o,
        "segments",
        lambda: stored(
            segments.customer_segments(
                marts.customer_order_features(_customers(sales)), restarts=o["restarts"]
            )
        ),
    )


def _daily_forecast(sales: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    return _once(
        o,
        "daily",
        lambda: stored(forecast.forecast_seasonal(marts.daily_summary(sales), o["horizon_days"])),
    )


# Defaults of the run; a caller may override any of them.
OPTIONS: dict[str, Any] = {
    "min_support": 0.01,
    "min_confidence": 0.3,
    "rule_confidence": 0.5,
    "trees": 50,
    "rounds": 200,
    "restarts": 10,
    "home": "United Kingdom",
    "horizon_days": 90,
}

# Table name -> what it holds, from the clean lines. Order is the order of writing.
STEPS: dict[str, Step] = {
    "sales_per_country": lambda s, o: marts.sales_per_country(s),
    "monthly_sales": lambda s, o: marts.monthly_sales(s),
    "customer_metrics": lambda s, o: marts.customer_metrics(s),
    "product_performance": lambda s, o: marts.product_performance(s),
    "customer_rfm_analysis": lambda s, o: rfm.rfm_fixed(s),
    "rfm_analysis": lambda s, o: rfm.rfm_quintile(_customers(s)),
    "customer_segments": lambda s, o: segments.segment_rank_names(_clustered(s, o)),
    "customer_segment_names": lambda s, o: segments.segment_names(_clustered(s, o)),
    "customer_churn_prediction": _forest,
    "churn_prediction": lambda s, o: churn.gbt_output(_boosted(s, o).predictions),
    "churn_model_summary": lambda s, o: _boosted(s, o).feature_importance(),
    "transaction_anomalies": lambda s, o: anomalies.anomalies(s),
    "frequent_itemsets": _itemsets,
    "product_associations": _rules,
    "product_pairs": lambda s, o: baskets.product_pairs(s, o["min_support"]),
    "product_affinity": lambda s, o: baskets.product_affinity(_customers(s)),
    "product_recommendations": lambda s, o: recommend.als_table(s),
    "neighbour_recommendations": lambda s, o: similarity.neighbour_recommendations(_customers(s)),
    "sales_forecast_lags": lambda s, o: forecast.forecast_lr_lags(marts.monthly_summary(s)),
    "sales_forecast": lambda s, o: forecast.forecast_lr_index(marts.monthly_sales(s)),
    "sales_forecast_monthly": lambda s, o: forecast.forecast_lr_recursive(marts.monthly_summary(s)),
    "sales_forecast_detailed": lambda s, o: forecast.confidence_width(_daily_forecast(s, o)),
    "sales_forecast_by_month": lambda s, o: series.monthly_from_daily(_daily_forecast(s, o), s),
}

PARTITIONS = {"monthly_sales": ("Year", "Month")}


def load(spark: SparkSession, path: str) -> None:
    """Put a landed file into the raw and the clean table.

    Both are partitioned by the file, the clean one by month below it. Loading a file again, as a retried run
    does, replaces what it brought before; other files and months are not touched. A file keeps its content.
    """
    landed = read_invoices_csv(spark, path).withColumn(SOURCE, F.lit(path))
    sinks.replace_partitions(landed, RAW, (SOURCE,))
    parsed = cleaning.parse_invoice_date(spark.table(RAW).where(F.col(SOURCE) == path))
    clean = cleaning.valid_sales(cleaning.add_line_columns(parsed))
    sinks.replace_partitions(clean, CLEAN, (SOURCE, "Year", "Month"))


def run(
    spark: SparkSession,
    path: str,
    database: str = DATABASE,
    tables: list[str] | None = None,
    **options: Any,
) -> DataFrame:
    """Load, write the tables (all, or the named ones) and report their row counts.

    Every table is computed from the stored clean lines, so the raw text is parsed once.
    """
    prepare(spark)
    sinks.ensure_database(spark, database)
    load(spark, path)
    settings = {**OPTIONS, **options, "fits": {}}
    written = [RAW, CLEAN]
    for name, step in STEPS.items():
        if tables is not None and name not in tables:
            continue
        sinks.drop_tables(spark, name)
        sinks.write_table(step(spark.table(CLEAN), settings), name, PARTITIONS.get(name, ()))
        written.append(name)
    drop_stored(spark)
    return row_counts({name: spark.table(name) for name in written})
