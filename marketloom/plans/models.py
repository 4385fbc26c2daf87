"""Clusters, churn models, frequent itemsets and factorisation: checked by rows and by tests.

Models have their default parameters. A session fits each once per folder; the queries share the fit.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import functions as F

from marketloom.operators import baskets, churn, evaluation, marts, recommend, reports, rfm, segments
from marketloom.plans.catalog import add, rounded
from marketloom.session import stored
from marketloom.sources.samples import Tables

_FITS: dict[tuple, Any] = {}


def _once(t: Tables, name: str, fit: Callable[[], Any]) -> Any:
    """What ``fit`` gives, computed at first use in this session and folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _FITS:
        _FITS[key] = fit()
    return _FITS[key]


# -------------------------------------------------------------------- segments


def _clustered(t):
    return _once(
        t, "segments", lambda: stored(segments.customer_segments(marts.customer_order_features(t.customer_sales)))
    )


def _named(t):
    return segments.segment_names(_clustered(t))


add("customer_segments", _clustered)
add("cluster_centers", lambda t: segments.cluster_centers(_clustered(t)))
add("cluster_profile_join", lambda t: segments.cluster_profile(_clustered(t)))
add("segment_names", _named)
add("segment_rank_names", lambda t: segments.segment_rank_names(_clustered(t)))
add("segment_metrics", lambda t: segments.segment_metrics(_named(t)))
add("segment_distribution_pct", lambda t: reports.distribution_pct(_named(t), "Segment"))
add("spend_box_stats", lambda t: rfm.box_stats(_named(t), "Segment", "TotalSpending"))

# ----------------------------------------------------------------------- churn


def _forest(t):
    return _once(t, "forest", lambda: churn.churn_rf(churn.customer_lifecycle(t.sales)))


def _boosted(t):
    return _once(
        t, "boosted", lambda: churn.churn_gbt(churn.churn_features(t.customer_sales, home="NATION_0"))
    )


def _metric(t, name):
    return evaluation.binary_metrics(_forest(t).holdout, "Churn", "ChurnPrediction", names=[name])


def _boosted_metric(t, name):
    return evaluation.binary_metrics(_boosted(t).holdout, "Churned", "ChurnPrediction", names=[name])


add("churn_rf", lambda t: churn.rf_output(_forest(t).predictions))
add("churn_gbt", lambda t: churn.gbt_output(_boosted(t).predictions))
add("churn_risk_levels", lambda t: reports.distribution(_boosted(t).predictions, "ChurnRiskLevel"))
add("churn_risk_summary", lambda t: churn.risk_summary(_boosted(t).predictions))
add("churn_by_recency_bin", lambda t: churn.churn_by_recency_bin(_boosted(t).predictions))
add(
    "churn_extremes",
    lambda t: churn.churn_extremes(churn.gbt_output(_boosted(t).predictions), riskiest=10, loyal=5),
)
add("feature_importance", lambda t: _boosted(t).feature_importance())
add(
    "fn_vector_element",
    lambda t: _forest(t).predictions.select("CustomerID", "ChurnRisk", "RiskCategory"),
)
add("eval_auc", lambda t: _metric(t, "auc"))
add("eval_accuracy", lambda t: _metric(t, "accuracy"))
add("eval_precision", lambda t: _metric(t, "precision"))
add("eval_auc_boosted", lambda t: _boosted_metric(t, "auc"))
add("eval_accuracy_boosted", lambda t: _boosted_metric(t, "accuracy"))
add(
    "eval_class_report",
    lambda t: evaluation.class_report(_boosted(t).holdout, "Churned", "ChurnPrediction"),
)

# ------------------------------------------------------- itemsets, factorisation


def _itemsets(t):
    return _once(t, "itemsets", lambda: baskets.frequent_itemsets(t.sales, 0.002, 0.03))


add(
    "frequent_itemsets",
    lambda t: _itemsets(t).freqItemsets.select(
        F.array_join(F.array_sort("items"), " + ").alias("items"), F.size("items").alias("length"), "freq"
    ),
)
add(
    "association_rules",
    lambda t: baskets.association_rules(_itemsets(t), 0.035).select(
        F.array_join("antecedent", " + ").alias("antecedent"),
        F.array_join("consequent", " + ").alias("consequent"),
        "confidence",
        "lift",
        "support",
    ),
)
add(
    "frequent_itemset_pairs",
    lambda t: _itemsets(t)
    .freqItemsets.where(F.size("items") <= 2)
    .select(F.array_join(F.array_sort("items"), " + ").alias("items"), "freq"),
    """SELECT Item AS items, COUNT(*) AS freq FROM basket_rows GROUP BY Item
       HAVING COUNT(*) >= 0.002 * (SELECT COUNT(*) FROM basket_n)
       UNION ALL SELECT Product_A || ' + ' || Product_B, Frequency FROM pair_counts
       WHERE Frequency >= 0.002 * (SELECT COUNT(*) FROM basket_n)""",
)
RULES_SQL = """
    SELECT antecedent, consequent, ROUND(confidence, 9) AS confidence,
           ROUND(confidence / (CAST(cb AS DOUBLE) / n), 9) AS lift, ROUND(CAST(Frequency AS DOUBLE) / n, 9) AS support
    FROM (SELECT p.*, b.c AS cb, CAST(p.Frequency AS DOUBLE) / a.c AS confidence,
                 (SELECT COUNT(*) FROM basket_n) AS n
          FROM (SELECT Product_A AS antecedent, Product_B AS consequent, Frequency FROM pair_counts
                UNION ALL SELECT Product_B, Product_A, Frequency FROM pair_counts) p
          JOIN (SELECT Item, COUNT(*) AS c FROM basket_rows GROUP BY Item) a ON a.Item = antecedent
          JOIN (SELECT Item, COUNT(*) AS c FROM basket_rows GROUP BY Item) b ON b.Item = consequent)
    WHERE Frequency >= 0.002 * n AND confidence > 0.035"""
add(
    "association_rules_single",
    lambda t: rounded(
        baskets.association_rules(_itemsets(t), 0.035)
        .where(F.size("antecedent") == 1)
        .select(
            F.get("antecedent", F.lit(0)).alias("antecedent"),
            F.get("consequent", F.lit(0)).alias("consequent"),
            "confidence",
            "lift",
            "support",
        ),
        9,
        "confidence",
        "lift",
        "support",
    ),
    RULES_SQL,
)
add(
    "rules_sorted",
    lambda t: rounded(baskets.pair_rules(t.sales, 0.002, 0.0), 9, "confidence", "lift", "support")
    .where(F.col("confidence") > 0.035)
    .orderBy(F.col("confidence").desc(), F.col("lift").desc(), "antecedent", "consequent"),
    RULES_SQL + " ORDER BY confidence DESC, lift DESC, antecedent, consequent",
)
add("als_recommendations", lambda t: recommend.als_table(t.sales, k=10))
