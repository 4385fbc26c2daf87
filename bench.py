"""Seconds per headline query. Prints one JSON line.

Every query runs over whole tables. Its result is written to Spark's ``noop`` sink, so all rows and
columns are computed and none are pulled to the driver.
"""

from __future__ import annotations

import json
import os
import time

from marketloom.plans.catalog import all_queries
from marketloom.session import build_session, drop_stored

HEADLINE = [
    "sales_per_country",
    "monthly_summary",
    "daily_summary",
    "product_performance",
    "customer_lifecycle",
    "kpi_overview",
    "rfm_fixed",
    "rfm_quintile",
    "churn_features",
    "anomalies",
    "anomaly_summary",
    "top_products_by_revenue",
    "revenue_lags",
    "product_pairs",
    "pair_rules",
    "product_affinity",
    "customer_similarity",
    "product_similarity",
    "neighbour_recommendations",
    "als_ratings",
    "bucket_10_min",
    "frequent_itemsets",
    "customer_segments",
    "churn_rf",
    "churn_gbt",
    "als_recommendations",
    "forecast_per_group",
    "association_rules",
    "eval_auc",
    "forecast_lr_lags",
    "forecast_seasonal",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR", f"/tmp/marketloom-bench-{os.getpid()}"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> None:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("sales_per_country")  # starts the JVM's code paths, not timed
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_stored(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
