"""Customer clusters and their names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.functions.columns import ratio
from marketloom.functions.quantiles import exact_quantiles
from marketloom.session import for_iterations, stored

CLUSTER_INPUT = ["TotalSpending", "TotalOrders"]

# Labels by falling mean spend.
RANK_NAMES = ["VIP Customers", "Regular Customers", "Occasional Buyers", "New Customers"]


def customer_segments(
    features: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42, centre: bool = True, at_once: int = 5
) -> DataFrame:
    """K-Means on standardised spend and orders; of several starts the one with the lowest cost stays.

    Each fit holds the scaled rows as its own vectors in executor storage until it ends, so that a pass decodes nothing, and
    ``at_once`` fits run side by side, so that the short jobs of one fill the cores that another leaves idle. Equal costs
    go to the first start.
    """
    numbers = stored(features).withColumns({f"_{c}": F.col(c).cast("double") for c in CLUSTER_INPUT})
    vectors = VectorAssembler(
        inputCols=[f"_{c}" for c in CLUSTER_INPUT], outputCol="_vector"
    ).transform(numbers)
    scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=centre)
    scaled = stored(scaler.fit(vectors).transform(vectors))
    rows = for_iterations(scaled.select("_scaled"))

    def fit(start: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + start, featuresCol="_scaled", predictionCol="Cluster").fit(rows)

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, restarts))) as pool:
        fits = list(pool.map(inheritable_thread_target(features.sparkSession)(fit), range(restarts)))
    model = min(fits, key=lambda one: one.summary.trainingCost)
    return model.transform(scaled).drop("_vector", "_scaled", *[f"_{c}" for c in CLUSTER_INPUT])


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Each customer with the means of its cluster. The profile has one row per cluster."""
    means = cluster_centers(clustered).select(
        F.col("Cluster").alias("_cluster"), "ClusterSpending", "ClusterOrders"
    )
    return clustered.join(means, F.col("Cluster") == F.col("_cluster")).drop("_cluster")


def cluster_centers(clustered: DataFrame) -> DataFrame:
    """Centres in the original units."""
    return clustered.groupBy("Cluster").agg(
        ratio(F.sum("TotalSpending"), F.count("TotalSpending")).alias("ClusterSpending"),
        ratio(F.sum("TotalOrders"), F.count("TotalOrders")).alias("ClusterOrders"),
        F.count(F.lit(1)).alias("Customers"),
    )


def segment_names(clustered: DataFrame) -> DataFrame:
    """Name a cluster by its means against the medians of all customers."""

    def median(column: str):
        return exact_quantiles(clustered, column, [0.5]).select(F.col("quantiles")[0]).scalar()

    rich = F.col("ClusterSpending") > median("TotalSpending") * 2
    often = F.col("ClusterOrders") > median("TotalOrders")
    name = (
        F.when(rich & often, "High Value Frequent")
        .when(rich, "High Value Occasional")
        .when(often, "Regular Shoppers")
        .otherwise("Low Engagement")
    )
    named = cluster_profile(clustered).withColumn("Segment", name)
    return named.drop("ClusterSpending", "ClusterOrders")


def segment_rank_names(clustered: DataFrame) -> DataFrame:
    """Label clusters by rank of mean spend instead of their arbitrary number."""
    ranked = cluster_centers(clustered).select(
        F.col("Cluster").alias("_cluster"),
        F.row_number().over(W.orderBy(F.col("ClusterSpending").desc(), "Cluster")).alias("_place"),
    )
    labels = F.array(*map(F.lit, RANK_NAMES))
    name = F.coalesce(F.try_element_at(labels, F.col("_place")), F.lit("Unknown"))
    return (
        clustered.join(ranked, F.col("Cluster") == F.col("_cluster"))
        .withColumn("SegmentName", name)
        .withColumnRenamed("Cluster", "SegmentID")
        .drop("_cluster", "_place")
    )


def segment_metrics(named: DataFrame, segment: str = "Segment") -> DataFrame:
    def mean(column: str):
        return F.round(ratio(F.sum(column), F.count(column)), 2)

    return named.groupBy(segment).agg(
        F.count("CustomerID").alias("Customers"),
        F.sum("TotalSpending").alias("TotalRevenue"),
        mean("TotalSpending").alias("AvgSpending"),
        mean("TotalOrders").alias("AvgOrders"),
        mean("TotalItems").alias("AvgItems"),
        F.round(F.avg("AvgOrderValue"), 2).alias("AvgOrderValue"),
    )
