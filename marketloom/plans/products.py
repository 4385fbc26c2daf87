"""Baskets, affinity, similarity and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import baskets, features, marts, recommend, reports, similarity
from marketloom.plans.catalog import add, rounded
from marketloom.session import stored

# The sample products are even, so the support floor is below the usual one percent.
SUPPORT = 0.003
# Nor do their prices differ by the usual factor of 1.5.
HIGH_VALUE = 1.03

# --------------------------------------------------------------------- baskets

add(
    "basket_items",
    lambda t: baskets.basket_summary(t.sales),
    """SELECT InvoiceNo, Lines, Items FROM basket_n
       JOIN (SELECT InvoiceNo, COUNT(*) AS Items FROM basket_rows GROUP BY InvoiceNo) USING (InvoiceNo)""",
)
add(
    "distinct_items_in_basket",
    lambda t: baskets.basket_items(t.sales).select("InvoiceNo", "Item"),
    "SELECT InvoiceNo, Item FROM basket_rows",
)
add(
    "basket_pairs",
    lambda t: baskets.basket_pairs(t.sales, 0.002),
    "SELECT * FROM pair_counts WHERE Frequency >= 0.002 * (SELECT COUNT(*) FROM basket_n)",
)
add(
    "product_pairs",
    lambda t: baskets.product_pairs(t.sales, SUPPORT, 100),
    "SELECT * FROM top_pairs",
)
add(
    "top_pairs",
    lambda t: baskets.product_pairs(t.sales, 0.001, 20).select("Product_A", "Product_B", "Frequency"),
    """SELECT * FROM pair_counts WHERE Frequency >= 0.001 * (SELECT COUNT(*) FROM basket_n)
       ORDER BY Frequency DESC, Product_A, Product_B LIMIT 20""",
)
add(
    "association_kpis",
    lambda t: baskets.association_kpis(baskets.product_pairs(t.sales, SUPPORT, 100)),
    """SELECT COUNT(*) AS PairsAnalyzed, CAST(SUM(Frequency) AS DOUBLE) / COUNT(*) AS AvgFrequency,
              MAX(Support) AS MaxSupport FROM top_pairs""",
)
add(
    "pair_rules",
    lambda t: rounded(
        baskets.pair_rules(t.sales, SUPPORT, 0.03), 9, "confidence", "lift", "support"
    ),
    """SELECT antecedent, consequent, ROUND(confidence, 9) AS confidence,
              ROUND(confidence / (CAST(cb AS DOUBLE) / n), 9) AS lift, ROUND(CAST(Frequency AS DOUBLE) / n, 9) AS support
       FROM (SELECT p.*, b.c AS cb, CAST(p.Frequency AS DOUBLE) / a.c AS confidence,
                    (SELECT COUNT(*) FROM basket_n) AS n
             FROM (SELECT Product_A AS antecedent, Product_B AS consequent, Frequency FROM pair_counts
                   UNION ALL SELECT Product_B, Product_A, Frequency FROM pair_counts) p
             JOIN (SELECT Item, COUNT(*) AS c FROM basket_rows GROUP BY Item) a ON a.Item = antecedent
             JOIN (SELECT Item, COUNT(*) AS c FROM basket_rows GROUP BY Item) b ON b.Item = consequent)
       WHERE Frequency >= 0.003 * n AND confidence >= 0.03""",
)
add(
    "product_affinity",
    lambda t: baskets.product_affinity(t.customer_sales, 5000, 100),
    """SELECT Product1, p1.Description AS Product1Description, Product2, p2.Description AS Product2Description,
              CooccurrenceCount, CAST(CooccurrenceCount AS DOUBLE) / invoice_total AS BundleScore
       FROM (SELECT a.StockCode AS Product1, b.StockCode AS Product2, COUNT(*) AS CooccurrenceCount,
                    (SELECT COUNT(*) FROM latest) AS invoice_total
             FROM items a JOIN items b ON a.InvoiceNo = b.InvoiceNo AND a.StockCode < b.StockCode
             GROUP BY 1, 2 ORDER BY CooccurrenceCount DESC, Product1, Product2 LIMIT 100)
       JOIN product_info p1 ON p1.StockCode = Product1 JOIN product_info p2 ON p2.StockCode = Product2""",
)

# ------------------------------------------------------------------ similarity


def _inter(t):
    return similarity.interactions(t.customer_sales)


def _matrix(t):
    return similarity.spend_matrix(t.customer_sales)


def _near(inter, k=5):
    return similarity.customer_similarity(inter, k)


def _on_matrix(build):
    return lambda t: build(_matrix(t))


def _recs(t):
    return similarity.neighbour_recommendations(t.customer_sales)


add(
    "interactions",
    _inter,
    "SELECT CustomerID, StockCode, CAST(Spend AS DOUBLE) AS Spend FROM inter",
)
add(
    "minmax_scaler",
    lambda t: rounded(similarity.minmax_scaled(_matrix(t)), 9, "Scaled"),
    "SELECT CustomerID, StockCode, ROUND(Scaled, 9) AS Scaled FROM scaled",
)
add(
    "customer_similarity",
    lambda t: _near(_matrix(t), 10),
    "SELECT CustomerID, Neighbour, Similarity, Rank FROM customer_near",
)
add(
    "top_k_neighbours",
    lambda t: _near(_matrix(t)),
    "SELECT CustomerID, Neighbour, Similarity, Rank FROM customer_near WHERE Rank <= 5",
)
add(
    "product_similarity",
    lambda t: similarity.product_similarity(_matrix(t), 5),
    """SELECT * FROM (
         SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY StockCode ORDER BY Similarity DESC, Neighbour)
                   AS INTEGER) AS Rank
         FROM (SELECT a.id AS StockCode, b.id AS Neighbour, ROUND(SUM(a.w * b.w), 9) AS Similarity
               FROM product_unit a JOIN product_unit b ON a.f = b.f AND a.id <> b.id GROUP BY 1, 2))
       WHERE Rank <= 5""",
)
add(
    "customer_similarity_by_description",
    # The samples have few product names, so each is shared by a large part of the customers.
    lambda t: similarity.nearest(
        similarity.unit_vectors(
            stored(
                t.customer_sales.where(F.col("Description").isNotNull())
                .groupBy("CustomerID", "Description")
                .agg(F.sum("TotalAmount").cast("double").alias("Spend"))
            ),
            "CustomerID",
            "Description",
            "Spend",
        )
    ).select(
        F.col("id").alias("CustomerID"),
        F.col("neighbour").alias("Neighbour"),
        F.col("similarity").alias("Similarity"),
    ).where(F.col("rank") <= 3).groupBy("CustomerID").agg(
        F.max("Similarity").alias("Closest"), F.count(F.lit(1)).alias("Neighbours")
    ),
    """SELECT CustomerID, ROUND(MAX(dot), 9) AS Closest, LEAST(COUNT(*), 3) AS Neighbours
       FROM (SELECT a.id AS CustomerID, b.id AS Neighbour, SUM(a.w * b.w) AS dot
             FROM described a JOIN described b ON a.f = b.f AND a.id <> b.id GROUP BY 1, 2) GROUP BY 1""",
)
add(
    "similarity_join",
    _on_matrix(lambda inter: similarity.shared_products(_near(inter), inter)),
    """SELECT n.CustomerID, n.Neighbour, COUNT(*) AS SharedProducts
       FROM customer_near n JOIN inter a ON a.CustomerID = n.CustomerID
       JOIN inter b ON b.CustomerID = n.Neighbour AND b.StockCode = a.StockCode
       WHERE n.Rank <= 5 GROUP BY 1, 2""",
)
add(
    "unseen_items",
    _on_matrix(lambda inter: similarity.unseen_items(_near(inter), inter)),
    "SELECT CustomerID, StockCode, CAST(Score AS DOUBLE) AS Score FROM unseen",
)
add(
    "set_difference",
    _on_matrix(lambda inter: similarity.new_products(_near(inter, 1), inter)),
    """SELECT n.CustomerID, i.StockCode FROM customer_near n JOIN inter i ON i.CustomerID = n.Neighbour
       WHERE n.Rank = 1 EXCEPT SELECT CustomerID, StockCode FROM inter""",
)
add("neighbour_recommendations", _recs, "SELECT * FROM recs")
add(
    "top_k_per_customer",
    lambda t: reports.top_k_per_key(
        _inter(t), ["CustomerID"], [F.col("Spend").desc(), F.col("StockCode")], 5
    ),
    """SELECT CustomerID, StockCode, CAST(Spend AS DOUBLE) AS Spend, CAST(rn AS INTEGER) AS Rank
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY Spend DESC, StockCode) AS rn FROM inter)
       WHERE rn <= 5""",
)
add(
    "recs_with_description",
    lambda t: similarity.with_descriptions(
        _recs(t).select("CustomerID", "ProductStockCode", "RecommendationScore"),
        marts.distinct_products(t.sales),
    ),
    """SELECT r.CustomerID, r.ProductStockCode, r.RecommendationScore, d.Description FROM recs r
       LEFT JOIN (SELECT StockCode, MIN(Description) AS Description FROM sales
                  WHERE Description IS NOT NULL GROUP BY StockCode) d ON d.StockCode = r.ProductStockCode""",
)
add(
    "recommendation_summary",
    lambda t: rounded(
        similarity.recommendation_summary(_recs(t), t.customer_sales), 4, "avg_score", "max_score"
    ),
    """SELECT COUNT(DISTINCT CustomerID) AS customers_with_recs, COUNT(*) AS total_recommendations,
              COUNT(DISTINCT ProductStockCode) AS unique_products, ROUND(AVG(RecommendationScore), 4) AS avg_score,
              ROUND(MAX(RecommendationScore), 4) AS max_score,
              CAST(COUNT(DISTINCT CustomerID) AS DOUBLE)
                / (SELECT COUNT(DISTINCT CustomerID) FROM cust_sales) * 100 AS coverage_pct FROM recs""",
)
add(
    "most_recommended",
    lambda t: reports.top_n(
        reports.distribution(_recs(t), "ProductDescription"), "count", ["ProductDescription"], 10
    ),
    """SELECT ProductDescription, COUNT(*) AS count FROM recs GROUP BY ProductDescription
       ORDER BY count DESC, ProductDescription LIMIT 10""",
)
add(
    "recommendation_rank_counts",
    lambda t: reports.distribution(_recs(t), "Rank"),
    "SELECT Rank, COUNT(*) AS count FROM recs GROUP BY Rank",
)
add(
    "top_recommendations",
    lambda t: reports.top_n(
        _recs(t).select("CustomerID", "ProductStockCode", "RecommendationScore"),
        "RecommendationScore",
        ["CustomerID", "ProductStockCode"],
        20,
    ),
    """SELECT CustomerID, ProductStockCode, RecommendationScore FROM recs
       ORDER BY RecommendationScore DESC, CustomerID, ProductStockCode LIMIT 20""",
)
add(
    "high_value_recs",
    lambda t: similarity.high_value_recommendations(_recs(t), t.customer_sales, HIGH_VALUE),
    """SELECT * FROM recs WHERE AveragePrice > 1.03 * (
         SELECT CAST(SUM(UnitPrice) AS DOUBLE) / COUNT(UnitPrice) FROM cust_sales WHERE Description IS NOT NULL)""",
)
add(
    "als_ratings",
    lambda t: recommend.als_ratings(t.sales),
    """SELECT CustomerID, StockCode, CAST(q AS BIGINT) AS TotalQuantity,
              CAST(CASE WHEN q >= 50 THEN 5 WHEN q >= 20 THEN 4 WHEN q >= 10 THEN 3 WHEN q >= 5 THEN 2 ELSE 1 END
                AS DOUBLE) AS rating
       FROM (SELECT CustomerID, StockCode, SUM(Quantity) AS q FROM sales
             WHERE CustomerID IS NOT NULL AND StockCode IS NOT NULL GROUP BY 1, 2)""",
)


def _index_check(t):
    """Whether the product index is dense and unique: one row of counts."""
    indexed, dimension = features.string_index(t.sales.select("StockCode"), "StockCode", "StockIndex")
    return dimension.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_distinct("StockIndex").alias("indexes"),
        F.min("StockIndex").alias("lowest"),
        F.max("StockIndex").alias("highest"),
    ).withColumn("indexed_lines", indexed.agg(F.count(F.lit(1))).scalar())


add(
    "string_index",
    _index_check,
    """SELECT COUNT(DISTINCT StockCode) AS products, COUNT(DISTINCT StockCode) AS indexes,
              CAST(0 AS INTEGER) AS lowest, CAST(COUNT(DISTINCT StockCode) - 1 AS INTEGER) AS highest,
              COUNT(*) AS indexed_lines FROM sales""",
)
