"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Names and order of the raw invoice columns.
RAW_INVOICES = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", MONEY),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

# The table written when the history is too short for a lag model.
LAG_FORECAST_DDL = (
    "year INT, month INT, actual_revenue DOUBLE, forecasted_revenue DOUBLE, "
    "forecast_lower DOUBLE, forecast_upper DOUBLE, accuracy DOUBLE"
)

# The columns the sample tables are read with.
SAMPLE_TABLES = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_returnflag STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
