"""Customer lifecycle, churn features, labels and churn models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import (
    at_least,
    at_most,
    calendar_days,
    elapsed_days,
    money_mean,
    position_in,
    ratio,
)
from marketloom.functions.keys import hash_position, train_test_split
from marketloom.functions.quantiles import column_quantiles
from marketloom.operators.cleaning import cut_date, fill_missing
from marketloom.session import for_iterations, stored

# The feature lists of the two models.
RF_FEATURES = ["TotalTransactions", "TotalSpent", "AvgOrderValue", "CustomerLifetime"]
GBT_FEATURES = [
    "Recency",
    "Frequency",
    "Monetary",
    "AvgOrderValue",
    "TenureDays",
    "PurchaseVariability",
    "AvgDaysBetween",
    "ProductDiversity",
    "IsUK",
    "Transactions90d",
]
RISK_ORDER = ["High", "Medium", "Low"]


@dataclass(frozen=True)
class ChurnModel:
    """A fitted model, every customer's prediction, and the predictions of the held-out customers."""

    model: PipelineModel
    features: list[str]
    predictions: DataFrame
    holdout: DataFrame

    def feature_importance(self) -> DataFrame:
        """One row per feature, most important first."""
        weights = self.model.stages[-1].featureImportances.toArray()
        rows = sorted(zip(self.features, map(float, weights)), key=lambda row: (-row[1], row[0]))
        return self.predictions.sparkSession.createDataFrame(rows, "Feature STRING, Importance DOUBLE")


def customer_lifecycle(sales: DataFrame) -> DataFrame:
    """First and last purchase, counts, spend, recency and lifetime per known customer."""
    lines = sales.where(F.col("CustomerID").isNotNull())
    # The newest sale is the newest of the customers' last ones, so the lines are read once.
    grouped = stored(
        lines.groupBy("CustomerID").agg(
            F.min("InvoiceDate").alias("FirstPurchase"),
            F.max("InvoiceDate").alias("LastPurchase"),
            F.count(F.lit(1)).alias("TotalTransactions"),
            F.sum("TotalAmount").alias("TotalSpent"),
            money_mean("TotalAmount").alias("AvgOrderValue"),
            F.coalesce(F.stddev_samp(F.col("TotalAmount").cast("double")), F.lit(0.0)).alias(
                "StdOrderValue"
            ),
        )
    )
    newest = grouped.agg(F.max("LastPurchase")).scalar()
    return grouped.withColumns(
        {
            "Recency": calendar_days("LastPurchase", newest),
            "CustomerLifetime": F.coalesce(calendar_days("FirstPurchase", "LastPurchase"), F.lit(0)),
        }
    )


def churn_by_recency(lifecycle: DataFrame, days: int = 90) -> DataFrame:
    return lifecycle.withColumn("Churn", (F.col("Recency") > days).cast("int"))


def churn_label(features: DataFrame, observation: DataFrame) -> DataFrame:
    """1 for a customer without a purchase in the observation period."""
    seen = observation.select(F.col("CustomerID").alias("_seen")).distinct()
    return (
        features.join(seen, F.col("CustomerID") == F.col("_seen"), "left")
        .withColumn("Churned", F.col("_seen").isNull().cast("int"))
        .drop("_seen")
    )


def active_customers(history: DataFrame, observation: DataFrame) -> DataFrame:
    """Customers of the history who bought again in the observation period."""
    return (
        history.select("CustomerID")
        .distinct()
        .join(observation.select("CustomerID"), "CustomerID", "left_semi")
    )


def _dated_flag(ts: Column, flag: Column) -> Column:
    """A time and a flag in one number that orders by time, then flagged first. The last bit is 0 for
    flagged. Unlike a struct or text it can be aggregated by hashing, without sorting the lines."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return micros * 2 + F.when(flag, F.lit(0)).otherwise(F.lit(1))


def churn_features(
    customer_sales: DataFrame, days: int = 30, recent: int = 90, home: str = "United Kingdom"
) -> DataFrame:
    """Ten features from the history before the cut date, and the label from the time after it.

    The columns that count are stored once, so the sales are joined once for the cut, the invoices and the products.
    One pass reduces lines to invoices, marked by side of the cut, and invoices to customers; another
    counts products. The mean gap between sorted invoice dates is the span from first to last over the
    number of gaps, so no ordering is needed.
    """
    lines = stored(customer_sales.select("CustomerID", "InvoiceNo", "StockCode", "InvoiceDate", "TotalAmount", "Country"))
    cut = cut_date(lines, days)
    date = F.col("InvoiceDate")
    invoices = lines.groupBy("CustomerID", "InvoiceNo", (date >= cut).alias("_seen")).agg(
        F.sum("TotalAmount").alias("_total"),
        F.count(F.lit(1)).alias("_lines"),
        F.min(date).alias("_first"),
        F.max(date).alias("_last"),
        F.min(_dated_flag(date, F.col("Country") == home)).alias("_home"),
        F.count_if(date >= cut - F.make_interval(days=F.lit(recent))).alias("_recent"),
    )

    def past(column: str) -> Column:
        return F.when(~F.col("_seen"), F.col(column))

    per_customer = (
        invoices.groupBy("CustomerID")
        .agg(
            F.max(past("_last")).alias("_last"),
            F.min(past("_first")).alias("_first"),
            F.max(past("_first")).alias("_last_start"),
            F.sum(past("_lines")).alias("Frequency"),
            F.sum(past("_total")).alias("Monetary"),
            F.coalesce(F.stddev_samp(past("_total").cast("double")), F.lit(0.0)).alias(
                "PurchaseVariability"
            ),
            F.count(past("_lines")).alias("_invoices"),
            F.min(past("_home")).alias("_home"),
            F.sum(past("_recent")).alias("Transactions90d"),
            F.max("_seen").alias("_back"),
        )
        .where(F.col("_first").isNotNull())
    )
    diversity = (
        lines.where(date < cut)
        .groupBy("CustomerID")
        .agg(F.count_distinct("StockCode").alias("ProductDiversity"))
    )
    tenure = elapsed_days("_first", cut)
    gaps = (
        F.when(F.col("Frequency") <= 1, tenure.cast("double"))
        .when(F.col("_invoices") == 1, F.lit(0.0))
        .otherwise(ratio(elapsed_days("_first", "_last_start"), F.col("_invoices") - 1))
    )
    return per_customer.join(diversity, "CustomerID").select(
        "CustomerID",
        elapsed_days("_last", cut).alias("Recency"),
        "Frequency",
        "Monetary",
        ratio("Monetary", "Frequency").alias("AvgOrderValue"),
        tenure.alias("TenureDays"),
        "PurchaseVariability",
        gaps.alias("AvgDaysBetween"),
        "ProductDiversity",
        (1 - F.pmod("_home", F.lit(2))).cast("int").alias("IsUK"),
        "Transactions90d",
        (~F.col("_back")).cast("int").alias("Churned"),
    )


def churn_rate(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("Customers"),
        F.sum("Churned").alias("ChurnedCustomers"),
        F.sum(1 - F.col("Churned")).alias("ActiveCustomers"),
        (ratio(F.sum("Churned"), F.count(F.lit(1))) * 100).alias("ChurnRate"),
    )


def stratified_split(
    df: DataFrame, label: str, keys: list[str], share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split that keeps the class shares: the cut is the exact quantile of a key hash in each class.

    The few classes become columns of one selection, so no row is shuffled by its class. Rows without a class are left out.
    Rows are stored with their hash, which the passes of the selection and both sides of the split read.
    """
    placed = stored(df.where(F.col(label).isNotNull()).withColumn("_place", hash_position(keys, seed).cast("double")))
    classes = sorted(r[0] for r in placed.select(label).distinct().collect())
    if not classes:
        return df.limit(0), df.limit(0)
    own = {f"_c{i}": F.when(F.col(label) == value, F.col("_place")) for i, value in enumerate(classes)}
    cuts = column_quantiles(placed.select(*[column.alias(name) for name, column in own.items()]), list(own), [share])
    cut = F.coalesce(*[F.when(F.col(label) == value, cuts[f"_c{i}"][0]) for i, value in enumerate(classes)])
    first = F.col("_place") < cut
    return placed.where(first).drop("_place"), placed.where(~first).drop("_place")


def churn_rf(
    lifecycle: DataFrame,
    trees: int = 50,
    depth: int = 10,
    churn_days: int = 90,
    use_recency: bool = False,
    seed: int = 42,
) -> ChurnModel:
    """Random forest on lifecycle features. Recency defines the label, so it is no feature by default."""
    names = (["Recency"] if use_recency else []) + RF_FEATURES
    data = churn_by_recency(lifecycle, churn_days)
    data = data.withColumns({name: F.col(name).cast("double") for name in names if name != "Recency"})
    data = stored(data)
    train, test = train_test_split(data, ["CustomerID"], 0.8, seed)
    stages = [
        VectorAssembler(inputCols=names, outputCol="rawFeatures"),
        StandardScaler(inputCol="rawFeatures", outputCol="scaledFeatures"),
        RandomForestClassifier(
            featuresCol="scaledFeatures",
            labelCol="Churn",
            predictionCol="ChurnPrediction",
            probabilityCol="ChurnProbability",
            numTrees=trees,
            maxDepth=depth,
            seed=seed,
        ),
    ]
    model = Pipeline(stages=stages).fit(train)
    risk = vector_to_array("ChurnProbability")[1]

    def predict(rows: DataFrame) -> DataFrame:
        return model.transform(rows).withColumns(
            {
                "ChurnRisk": risk,
                "RiskCategory": at_least(
                    risk, [0.7, 0.4], ["High Risk", "Medium Risk"], "Low Risk"
                ),
            }
        )

    return ChurnModel(model, names, predict(data), predict(test))


def rf_output(predictions: DataFrame) -> DataFrame:
    """The columns of the prediction table."""
    return predictions.select(
        "CustomerID",
        "Recency",
        "TotalTransactions",
        "TotalSpent",
        "AvgOrderValue",
        "Churn",
        "ChurnPrediction",
        "ChurnRisk",
        "RiskCategory",
    )


def risk_level(probability: str = "ChurnRisk"):
    """Low up to 0.3, Medium up to 0.6, High above; 0 counts as Low."""
    return at_most(probability, [0.3, 0.6], ["Low", "Medium"], "High")


def churn_gbt(
    features: DataFrame,
    rounds: int = 200,
    depth: int = 6,
    rate: float = 0.1,
    sample: float = 0.8,
    seed: int = 42,
) -> ChurnModel:
    """Boosted trees with the positive class weighted by the class ratio.

    Rows are binned once and held in executor storage by the fit; a round is some jobs over them, one for each level of
    its tree, so few rows are few tasks.
    """
    data = stored(fill_missing(features, *GBT_FEATURES))
    train, test = stratified_split(data, "Churned", ["CustomerID"], 0.8, seed)
    share = train.agg(F.avg("Churned").alias("p")).scalar()
    weight = F.when(F.col("Churned") == 1, F.coalesce(F.try_divide(1 - share, share), F.lit(1.0)))
    train = for_iterations(train.withColumn("_weight", weight.otherwise(F.lit(1.0))))
    stages = [
        VectorAssembler(inputCols=GBT_FEATURES, outputCol="vector"),
        GBTClassifier(
            featuresCol="vector",
            labelCol="Churned",
            weightCol="_weight",
            predictionCol="ChurnPrediction",
            maxIter=rounds,
            maxDepth=depth,
            stepSize=rate,
            subsamplingRate=sample,
            featureSubsetStrategy=str(sample),
            checkpointInterval=10,
            seed=seed,
        ),
    ]
    model = Pipeline(stages=stages).fit(train)
    risk = vector_to_array("probability")[1]

    def predict(rows: DataFrame) -> DataFrame:
        scored = model.transform(rows).withColumn("ChurnRisk", risk)
        return scored.withColumn("ChurnRiskLevel", risk_level())

    return ChurnModel(model, GBT_FEATURES, predict(data), predict(test))


def gbt_output(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "CustomerID",
        "Recency",
        "Frequency",
        "Monetary",
        "TenureDays",
        "ChurnRisk",
        "ChurnPrediction",
        "ChurnRiskLevel",
    )


def risk_summary(predictions: DataFrame, level: str = "ChurnRiskLevel") -> DataFrame:
    """Customers and mean risk per level with the share of all customers, worst level first."""
    total = predictions.agg(F.count(F.lit(1))).scalar()
    return (
        predictions.groupBy(level)
        .agg(F.count(F.lit(1)).alias("customer_count"), F.avg("ChurnRisk").alias("avg_probability"))
        .withColumn("pct", ratio("customer_count", total) * 100)
        .orderBy(position_in(F.split(level, " ")[0], RISK_ORDER))
    )


def churn_by_recency_bin(predictions: DataFrame) -> DataFrame:
    """Mean risk per recency bin; the first bin holds 0 and the last is open."""
    bins = at_most("Recency", [30, 60, 90], ["0-30d", "30-60d", "60-90d"], "90d+")
    return predictions.groupBy(bins.alias("RecencyBin")).agg(
        (F.avg("ChurnRisk") * 100).alias("AvgChurnRiskPct"), F.count(F.lit(1)).alias("Customers")
    )


def churn_extremes(predictions: DataFrame, riskiest: int = 5, loyal: int = 5) -> DataFrame:
    """Both ends of the risk order, two top-k lists. The predictions are stored, so the model scores every row once."""
    predictions = stored(predictions)
    worst = predictions.orderBy(F.col("ChurnRisk").desc(), "CustomerID").limit(riskiest)
    best = predictions.orderBy(F.col("ChurnRisk").asc(), F.col("CustomerID").desc()).limit(loyal)
    return worst.withColumn("Side", F.lit("Highest risk")).unionByName(
        best.withColumn("Side", F.lit("Most loyal"))
    )
