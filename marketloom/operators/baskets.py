"""Products bought together.

Counting pairs means meeting the products of an invoice with each other. What keeps that small is exact:

* with a support floor, a pair can only be frequent if both products are. Of n invoices with m distinct
  (invoice, product) rows in all, at most m / (n * floor) products can be, so that bounds every invoice,
  however long;
* without a floor (``product_affinity``), long invoices are left out of the pairing and looked up.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import ratio
from marketloom.functions.keys import spread
from marketloom.operators.marts import product_info
from marketloom.operators.reports import top_k_per_key
from marketloom.session import stored


def item_lines(sales: DataFrame, item: str = "Description") -> DataFrame:
    """Lines per invoice and product, stored: sizes, items and counts of baskets all come from it."""
    lines = sales.where(F.col(item).isNotNull() & F.col("InvoiceNo").isNotNull())
    return stored(lines.groupBy("InvoiceNo", F.col(item).alias("Item")).agg(F.count(F.lit(1)).alias("ItemLines")))


def basket_sizes(lines: DataFrame) -> DataFrame:
    """Invoices with at least two lines and their number of lines, from ``item_lines``."""
    return lines.groupBy("InvoiceNo").agg(F.sum("ItemLines").alias("Lines")).where(F.col("Lines") >= 2)


def basket_items(sales: DataFrame, item: str = "Description") -> DataFrame:
    """The distinct products of invoices with at least two lines, one row per (invoice, product)."""
    lines = item_lines(sales, item)
    return lines.join(basket_sizes(lines).select("InvoiceNo"), "InvoiceNo", "left_semi")


def basket_summary(sales: DataFrame, item: str = "Description") -> DataFrame:
    """Lines and distinct products of every invoice with at least two lines."""
    lines = item_lines(sales, item).groupBy("InvoiceNo")
    return lines.agg(F.sum("ItemLines").alias("Lines"), F.count(F.lit(1)).alias("Items")).where(F.col("Lines") >= 2)


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("Item").agg(F.count(F.lit(1)).alias("ItemCount"))


@dataclass(frozen=True)
class Baskets:
    """Number of invoices with two or more lines, and their rows of frequent products."""

    total: int
    floor: float
    items: DataFrame
    invoices: DataFrame

    def share(self, count: Column | str) -> Column:
        return ratio(count, F.lit(self.total))


def frequent_baskets(sales: DataFrame, min_support: float, item: str = "Description") -> Baskets:
    """Baskets cut to the products that reach the support. The rows are stored: pairing reads them twice."""
    lines = item_lines(sales, item)
    invoices = basket_sizes(lines).select("InvoiceNo")
    total = invoices.count()
    floor = total * min_support
    items = lines.join(invoices, "InvoiceNo", "left_semi").select("InvoiceNo", "Item")
    frequent = item_counts(items).where(F.col("ItemCount") >= floor).select("Item")
    return Baskets(total, floor, stored(items.join(frequent, "Item", "left_semi")), invoices)


def _pair_counts(items: DataFrame, ways: int = 1) -> DataFrame:
    """Invoices per unordered pair. ``ways`` spreads every invoice over that many tasks."""
    left = items.select("InvoiceNo", F.col("Item").alias("Product_A"))
    right = items.select("InvoiceNo", F.col("Item").alias("Product_B"))
    keys = ["InvoiceNo"]
    if ways > 1:
        left, right = spread(left, right, "Product_A", ways)
        keys.append("_way")
    return (
        left.join(right, keys)
        .where(F.col("Product_A") < F.col("Product_B"))
        .groupBy("Product_A", "Product_B")
        .agg(F.count(F.lit(1)).alias("Frequency"))
    )


def frequent_pairs(baskets: Baskets) -> DataFrame:
    return _pair_counts(baskets.items).where(F.col("Frequency") >= baskets.floor)


def basket_pairs(sales: DataFrame, min_support: float = 0.01, item: str = "Description") -> DataFrame:
    """Every unordered pair of products with at least the support, with its number of invoices."""
    return frequent_pairs(frequent_baskets(sales, min_support, item))


def product_pairs(
    sales: DataFrame, min_support: float = 0.01, limit: int = 100, item: str = "Description"
) -> DataFrame:
    """The most frequent pairs with their support in percent."""
    baskets = frequent_baskets(sales, min_support, item)
    best = frequent_pairs(baskets).orderBy(F.col("Frequency").desc(), "Product_A", "Product_B")
    return best.limit(limit).withColumn("Support", F.round(baskets.share("Frequency") * 100, 2))


def pair_rules(
    sales: DataFrame,
    min_support: float = 0.01,
    min_confidence: float = 0.3,
    item: str = "Description",
) -> DataFrame:
    """One-product rules in both directions with support, confidence and lift."""
    baskets = frequent_baskets(sales, min_support, item)
    both = frequent_pairs(baskets).select(
        F.explode(
            F.array(
                F.struct(F.col("Product_A").alias("a"), F.col("Product_B").alias("b")),
                F.struct(F.col("Product_B").alias("a"), F.col("Product_A").alias("b")),
            )
        ).alias("rule"),
        "Frequency",
    ).select(F.col("rule.a").alias("antecedent"), F.col("rule.b").alias("consequent"), "Frequency")
    counts = item_counts(baskets.items)
    left = counts.select(F.col("Item").alias("antecedent"), F.col("ItemCount").alias("_a"))
    right = counts.select(F.col("Item").alias("consequent"), F.col("ItemCount").alias("_b"))
    confidence = ratio("Frequency", "_a")
    return (
        both.join(left, "antecedent")
        .join(right, "consequent")
        .select(
            "antecedent",
            "consequent",
            confidence.alias("confidence"),
            F.try_divide(confidence, baskets.share("_b")).alias("lift"),
            baskets.share("Frequency").alias("support"),
        )
        .where(F.col("confidence") >= min_confidence)
    )


@dataclass(frozen=True)
class Itemsets:
    """Frequent itemsets and the rules of one consequent, under the names that MLlib's model has for them."""

    freqItemsets: DataFrame
    associationRules: DataFrame


def _set_counts(rows: DataFrame, size: int, known: dict[int, DataFrame]) -> DataFrame:
    """Baskets per set of ``size`` products. A set grows in the order of the basket's sorted array, from frequent sets alone."""
    sets = rows.select(F.array().cast("array<string>").alias("items"), F.col("items").alias("_rest"))
    for length in range(1, size + 1):
        # Neither the set nor what it can grow to is made where too few products are left.
        sets = sets.select("items", "_rest", F.posexplode(F.slice("_rest", 1, F.size("_rest") - F.lit(size - length))))
        grown = F.array_append("items", F.col("col"))
        sets = sets.select(grown.alias("items"), F.slice("_rest", F.col("pos") + 2, F.size("_rest")).alias("_rest"))
        if length in known:
            sets = sets.join(known[length].select("items"), "items", "left_semi")
    return sets.groupBy("items").agg(F.count(F.lit(1)).alias("freq"))


def frequent_itemsets(
    sales: DataFrame,
    min_support: float = 0.01,
    min_confidence: float = 0.3,
    item: str = "Description",
    per_row: int = 64,
) -> Itemsets:
    """Every frequent set of products of invoices with at least two lines, and its rules; both are stored.

    Infrequent products leave before the baskets are gathered, so no basket array outgrows the number of
    frequent products; a basket that loses all of them still counts in the support.

    Sets are counted by rising length, larger ones only where a smaller one is frequent. That takes one row for each set of a
    basket, summed up before the shuffle, and ends with the first length without a frequent set. Where baskets would have more than
    ``per_row`` sets of a length for each of their products, FP-Growth finds the sets from that length on. FP-Growth
    alone would hold every basket of every task in trees, however short the frequent sets are.
    """
    baskets = frequent_baskets(sales, min_support, item)
    floor = max(1, math.ceil(baskets.floor))
    gathered = baskets.items.groupBy("InvoiceNo").agg(F.array_sort(F.collect_list("Item")).alias("items"))
    rows = stored(gathered.select("items").where(F.size("items") >= 2))
    # One row per length of a basket, and baskets are no longer than there are frequent products.
    lengths = {r["n"]: r["count"] for r in rows.groupBy(F.size("items").alias("n")).count().collect()}
    products = sum(n * count for n, count in lengths.items())
    singles = item_counts(baskets.items).select(F.array("Item").alias("items"), F.col("ItemCount").alias("freq"))
    found, known, size = [singles], {}, 2
    while any(n >= size for n in lengths):
        held = rows.where(F.size("items") >= size)
        if sum(math.comb(n, size) * count for n, count in lengths.items()) > per_row * products:
            total = sum(count for n, count in lengths.items() if n >= size)
            if floor <= total:
                # Half under the count, so that rounding doesn't move it.
                grown = FPGrowth(itemsCol="items", minSupport=(floor - 0.5) / total).fit(held).freqItemsets
                found.append(grown.where(F.size("items") >= size))
            break
        known[size] = stored(_set_counts(held, size, known).where(F.col("freq") >= floor))
        if known[size].isEmpty():
            break
        found.append(known[size])
        size += 1
    sets = stored(reduce(DataFrame.unionByName, found))
    return Itemsets(sets, stored(_rules(baskets, sets, min_confidence)))


def _rules(baskets: Baskets, sets: DataFrame, min_confidence: float) -> DataFrame:
    """Rules with one product as consequent; what is frequent as a whole is so in its parts, so every part is among the sets."""
    parts = sets.where(F.size("items") > 1).select(F.explode("items").alias("_item"), "items", "freq")
    rules = parts.select(
        F.array_sort(F.array_remove("items", F.col("_item"))).alias("antecedent"), F.array("_item").alias("consequent"), "freq"
    )
    counts = sets.select(F.array_sort("items").alias("_set"), F.col("freq").cast("double").alias("_freq"))
    left = counts.select(F.col("_set").alias("antecedent"), F.col("_freq").alias("_a"))
    right = counts.where(F.size("_set") == 1).select(F.col("_set").alias("consequent"), F.col("_freq").alias("_b"))
    confidence = F.col("freq") / F.col("_a")
    total = F.lit(float(baskets.total))
    return (
        rules.join(left, "antecedent")
        .where(confidence >= min_confidence)
        .join(right, "consequent")
        .select(
            "antecedent",
            "consequent",
            confidence.alias("confidence"),
            (confidence / F.try_divide("_b", total)).alias("lift"),
            F.try_divide(F.col("freq"), total).alias("support"),
        )
    )


def association_rules(model: Itemsets, min_confidence: float = 0.5) -> DataFrame:
    """Rules above a confidence, strongest first."""
    return model.associationRules.where(F.col("confidence") > min_confidence).orderBy(
        F.col("confidence").desc(), F.col("lift").desc(), "antecedent", "consequent"
    )


def association_kpis(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count(F.lit(1)).alias("PairsAnalyzed"),
        ratio(F.sum("Frequency"), F.count("Frequency")).alias("AvgFrequency"),
        F.max("Support").alias("MaxSupport"),
    )


def latest_invoices(sales: DataFrame, n: int = 5000) -> DataFrame:
    """The newest invoices by date and number; a top-k that keeps n rows per task."""
    return (
        sales.groupBy("InvoiceNo")
        .agg(F.max("InvoiceDate").alias("_newest"))
        .orderBy(F.col("_newest").desc(), F.col("InvoiceNo").desc())
        .limit(n)
        .select("InvoiceNo")
    )


def top_pairs(items: DataFrame, limit: int = 100, long_basket: int = 1000) -> DataFrame:
    """The most frequent pairs of (InvoiceNo, Item) rows, ties by name, exact for any basket length.

    Baskets over ``long_basket`` products are not paired as a whole. A pair that belongs to the result
    shares a short basket, or shares two long ones (so both products are in two long ones), or has a
    single long basket; then only the first ``limit`` pairs of that basket by name can place, and those
    lie among its first ``limit + 1`` products. Pairs from all three sources are then looked up in the
    long baskets, which costs one row per pair and long basket.
    """
    sizes = items.groupBy("InvoiceNo").agg(F.count(F.lit(1)).alias("_size"))
    long_ids = sizes.where(F.col("_size") > long_basket).select("InvoiceNo")
    names = ["Product_A", "Product_B"]
    order = [F.col("Frequency").desc(), *names]
    if long_ids.isEmpty():
        return _pair_counts(items).orderBy(*order).limit(limit)
    short = items.join(long_ids, "InvoiceNo", "left_anti")
    long = items.join(long_ids, "InvoiceNo", "left_semi")

    counted = _pair_counts(short)
    shared = long.groupBy("Item").agg(F.count(F.lit(1)).alias("_in")).where(F.col("_in") > 1)
    repeated = _pair_counts(long.join(shared.select("Item"), "Item", "left_semi"), ways=32)
    heads = top_k_per_key(long, ["InvoiceNo"], [F.col("Item")], limit + 1, "_place")
    single = _pair_counts(heads.select("InvoiceNo", "Item"))

    none = F.lit(0).cast("bigint").alias("Frequency")
    from_short = counted.unionByName(
        repeated.select(*names, none).unionByName(single.select(*names, none))
    ).groupBy(*names).agg(F.sum("Frequency").alias("_short"))
    in_long = (
        from_short.join(long.select(F.col("Item").alias("Product_A"), "InvoiceNo"), "Product_A")
        .join(long.select(F.col("Item").alias("Product_B"), "InvoiceNo"), ["Product_B", "InvoiceNo"])
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_long"))
    )
    total = F.col("_short") + F.coalesce("_long", F.lit(0))
    return (
        from_short.join(in_long, names, "left")
        .select(*names, total.alias("Frequency"))
        .orderBy(*order)
        .limit(limit)
    )


def product_affinity(
    customer_sales: DataFrame, last_invoices: int = 5000, limit: int = 100, long_basket: int = 1000
) -> DataFrame:
    """Product pairs on the newest invoices; the score is their share of these invoices."""
    named = customer_sales.where(F.col("Description").isNotNull())
    latest = stored(latest_invoices(named, last_invoices))
    items = stored(
        named.join(latest, "InvoiceNo", "left_semi")
        .select("InvoiceNo", F.col("StockCode").alias("Item"))
        .distinct()
    )
    pairs = top_pairs(items, limit, long_basket)
    invoices = latest.agg(F.count(F.lit(1))).scalar()
    info = product_info(named)

    def side(i: int) -> DataFrame:
        return info.select(
            F.col("StockCode").alias(f"Product{i}"), F.col("Description").alias(f"Product{i}Description")
        )

    return (
        pairs.select(
            F.col("Product_A").alias("Product1"),
            F.col("Product_B").alias("Product2"),
            F.col("Frequency").alias("CooccurrenceCount"),
            ratio("Frequency", invoices).alias("BundleScore"),
        )
        .join(side(1), "Product1")
        .join(side(2), "Product2")
    )
