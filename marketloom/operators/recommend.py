"""Recommendations by matrix factorisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import at_least
from marketloom.functions.keys import dense_ids, ordered_ids
from marketloom.operators.marts import distinct_products, quantity_per_customer_item
from marketloom.operators.reports import top_k_per_key
from marketloom.operators.similarity import with_descriptions
from marketloom.session import ensure_checkpoint_dir, stored

#: Products in a block, and customers that meet a block at once, about.
BLOCK = 1 << 13
CHUNK = 1 << 12
#: Scores that a task holds at once.
HELD = 1 << 22
#: Blocks that a task reads for its customers.
BLOCKS_AT_ONCE = 32
#: Scores are single-precision sums; bounds are wider by so much.
SLACK = 1e-5


def als_ratings(sales: DataFrame) -> DataFrame:
    """Bought quantity per customer and product as a rating from 1 to 5."""
    lines = sales.where(
        F.col("CustomerID").isNotNull() & F.col("StockCode").isNotNull() & (F.col("Quantity") > 0)
    )
    rating = at_least("TotalQuantity", [50, 20, 10, 5], [5.0, 4.0, 3.0, 2.0], 1.0)
    return quantity_per_customer_item(lines).withColumn("rating", rating)


def _met(pairs: DataFrame, k: int) -> DataFrame:
    """The k products of a block with the highest scores over a customer's floor, from rows with some customers and a block each."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            users, ids = row["users"].flatten(), row["ids"].flatten().to_numpy()
            reach = users.field("reach").to_numpy() * row["most"][0].as_py()
            users = users.filter(pa.array(reach > users.field("floor").to_numpy()))
            if not len(users):
                continue
            mine = pc.list_flatten(users.field("features")).to_numpy().reshape(len(users), -1)
            theirs = row["fs"].flatten().to_numpy().reshape(len(ids), -1).T
            names, floors, step = users.field("id").to_numpy(), users.field("floor").to_numpy(), max(1, HELD // len(ids))
            for at in range(0, len(names), step):
                scores, least = mine[at : at + step] @ theirs, floors[at : at + step]
                if len(ids) > k:
                    # Only where more than k reach the floor, which is seldom after the first block.
                    many = np.flatnonzero(np.count_nonzero(scores >= least[:, None], axis=1) > k)
                    if len(many):
                        least = least.copy()
                        least[many] = np.maximum(least[many], np.partition(scores[many], -k, axis=1)[:, -k])
                who, what = np.divmod(np.flatnonzero((scores >= least[:, None]).ravel()), len(ids))
                rating = scores[who, what]
                order = np.lexsort((ids[what], -rating, who))
                who, what, rating = who[order], what[order], rating[order]
                first = np.arange(len(who)) - np.searchsorted(who, who) < k
                columns = [names[at + who[first]], ids[what[first]], rating[first]]
                yield pa.record_batch([pa.array(c) for c in columns], names=["user", "item", "rating"])

    return pairs.select("users", "ids", "fs", "most").mapInArrow(best, "user int, item int, rating float")


def _length(features: str) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def top_items(users: DataFrame, items: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """The k items with the largest products of factors per user: user, item, rating, place. Inputs have id and features.

    The same as MLlib's ``recommendForAllUsers``, exact, of equal scores maybe others; that one multiplies all users by all items. Here items lie
    in blocks by falling length of their factors. All users meet the first block, whose k-th score is a floor; a product is at
    most the product of lengths, so a user meets only the blocks whose longest item can pass the floor.
    """
    block = max(block, k)
    ranked = items.select(F.struct((-_length("features")).alias("n"), "id", "features").alias("item"))
    ranked = ordered_ids(ranked, "item", "_place").withColumn("block", F.floor(F.col("_place") / F.lit(block)).cast("int"))
    blocks = ranked.groupBy("block").agg(F.collect_list("item").alias("_items"))
    most = (-F.array_min("_items.n")).alias("most")
    blocks = stored(blocks.select("block", F.col("_items.id").alias("ids"), F.flatten("_items.features").alias("fs"), most))
    chunks = max(1, -(-users.count() // CHUNK))
    reach = (_length("features") * (1 + SLACK)).alias("reach")
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk")
    people = stored(users.select("id", "features", reach, chunk))

    def together(asking: DataFrame) -> DataFrame:
        return asking.groupBy("chunk").agg(F.collect_list(F.struct("id", "features", "reach", "floor")).alias("users"))

    everybody = together(people.withColumn("floor", F.lit(float("-inf")).cast("float")))
    # One block, whose size is set.
    found = stored(_met(everybody.crossJoin(F.broadcast(blocks.where(F.col("block") == 0))), k))
    floors = found.groupBy(F.col("user").alias("id")).agg(F.min("rating").alias("floor"))
    asking = stored(together(people.join(floors, "id"))).repartition(chunks)
    rest = blocks.where(F.col("block") > 0)
    rest = rest.repartition(rest.count() // BLOCKS_AT_ONCE + 1)
    # Chunks and blocks meet where they are read; sending a user to each of its blocks would fill the disk.
    found = found.unionByName(_met(asking.crossJoin(rest), k))
    return top_k_per_key(found, ["user"], [F.col("rating").desc(), F.col("item")], k, "place")


def als_recommendations(
    ratings: DataFrame,
    products: DataFrame | None = None,
    k: int = 10,
    rank: int = 10,
    iters: int = 10,
    reg: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Top products per customer. Text keys get dense ids by a join and are mapped back by a join."""
    ratings = stored(ratings)
    ensure_checkpoint_dir(ratings.sparkSession)
    customers = dense_ids(ratings, "CustomerID", "_user")
    items = dense_ids(ratings, "StockCode", "_item")
    indexed = (
        ratings.join(customers, "CustomerID")
        .join(items, "StockCode")
        .select("_user", "_item", "rating")
    )
    als = ALS(
        userCol="_user",
        itemCol="_item",
        ratingCol="rating",
        coldStartStrategy="drop",
        nonnegative=True,
        implicitPrefs=False,
        rank=rank,
        maxIter=iters,
        regParam=reg,
        # What a fit has shuffled goes at each checkpoint, which holds factors alone.
        checkpointInterval=1,
        seed=seed,
    )
    model = als.fit(indexed)
    best = top_items(model.userFactors, model.itemFactors, k)
    flat = best.select(
        F.col("user").alias("_user"), F.col("item").alias("_item"), F.col("rating").alias("RecommendationScore")
    )
    named = (
        flat.join(customers, "_user")
        .join(items, "_item")
        .select(
            "CustomerID",
            F.col("StockCode").alias("ProductStockCode"),
            F.col("RecommendationScore").cast("double").alias("RecommendationScore"),
        )
    )
    return named if products is None else with_descriptions(named, products)


def als_table(sales: DataFrame, **parameters) -> DataFrame:
    """Ratings, factorisation and product names in one step, with the table's column names."""
    return als_recommendations(als_ratings(sales), distinct_products(sales), **parameters).select(
        "CustomerID",
        F.col("ProductStockCode").alias("RecommendedProduct"),
        "Description",
        "RecommendationScore",
    )
