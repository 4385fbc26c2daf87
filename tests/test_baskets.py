from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest

from marketloom.operators import baskets


def _brute(rows, limit):
    by = {}
    for invoice, item in rows:
        by.setdefault(invoice, set()).add(item)
    counts = Counter()
    for items in by.values():
        counts.update(itertools.combinations(sorted(items), 2))
    return sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda r: (-r[2], r[0], r[1]))[:limit]


def _random_rows(seed, long):
    rng = random.Random(seed)
    rows = set()
    for i in range(60):
        for _ in range(rng.randint(1, 6)):
            rows.add((f"i{i}", f"p{rng.randrange(80):02d}"))
    for j in range(long):
        for item in rng.sample(range(80), 40):
            rows.add((f"long{j}", f"p{item:02d}"))
    return sorted(rows)


@pytest.mark.parametrize("long", [0, 1, 2, 4])
@pytest.mark.parametrize("limit", [3, 25, 400])
def test_top_pairs_equal_brute_force_with_long_baskets(spark, long, limit):
    rows = _random_rows(long * 10 + 1, long)
    df = spark.createDataFrame(rows, "InvoiceNo STRING, Item STRING")
    found = [tuple(r) for r in baskets.top_pairs(df, limit, long_basket=12).collect()]
    assert sorted(found) == sorted(_brute(rows, limit))


def test_one_long_basket_alone(spark):
    rows = [("only", f"p{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "InvoiceNo STRING, Item STRING")
    found = [tuple(r) for r in baskets.top_pairs(df, 10, long_basket=12).collect()]
    assert sorted(found) == sorted(_brute(rows, 10))


@pytest.fixture(scope="module")
def sales(make_lines):
    day = "2011-01-01"
    return make_lines(
        ("1", "A", 1, 1, "u", day),
        ("1", "A", 1, 1, "u", day),
        ("1", "B", 1, 1, "u", day),
        ("2", "A", 1, 1, "u", day),
        ("2", "A", 1, 1, "u", day),
        ("3", "A", 1, 1, "v", day),
        ("3", "B", 1, 1, "v", day),
        ("3", "C", 1, 1, "v", day),
        ("4", "C", 1, 1, "v", day),
    )


def test_repeated_products_count_as_lines_but_make_no_pair(sales):
    sizes = {r["InvoiceNo"]: r["Lines"] for r in baskets.basket_sizes(baskets.item_lines(sales)).collect()}
    assert sizes == {"1": 3, "2": 2, "3": 3}
    items = {}
    for r in baskets.basket_items(sales).collect():
        items.setdefault(r["InvoiceNo"], set()).add(r["Item"])
    assert items == {"1": {"item A", "item B"}, "2": {"item A"}, "3": {"item A", "item B", "item C"}}


def test_pair_support_divides_by_invoices_with_two_lines(sales):
    rows = baskets.product_pairs(sales, 0.5).collect()
    assert [tuple(r) for r in rows] == [("item A", "item B", 2, 66.67)]


def test_rules(sales):
    rules = {
        (r["antecedent"], r["consequent"]): r
        for r in baskets.pair_rules(sales, 0.5, 0.0).collect()
    }
    forward, back = rules[("item A", "item B")], rules[("item B", "item A")]
    assert forward["confidence"] == pytest.approx(2 / 3) and back["confidence"] == pytest.approx(1.0)
    assert forward["lift"] == back["lift"] == pytest.approx(1.0)
    assert forward["support"] == pytest.approx(2 / 3)


def test_pair_support_is_at_most_that_of_its_products(sales):
    found = baskets.frequent_baskets(sales, 0.3)
    counts = {r["Item"]: r["ItemCount"] for r in baskets.item_counts(found.items).collect()}
    for r in baskets.frequent_pairs(found).collect():
        assert r["Frequency"] <= min(counts[r["Product_A"]], counts[r["Product_B"]])


def test_itemsets_equal_pairs_and_count_all_baskets(sales):
    model = baskets.frequent_itemsets(sales, 0.3, 0.1)
    sets = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.collect()}
    pairs = {
        (r["Product_A"], r["Product_B"]): r["Frequency"] for r in baskets.basket_pairs(sales, 0.3).collect()
    }
    assert {k: v for k, v in sets.items() if len(k) == 2} == pairs
    assert sets[("item A",)] == 3 and sets[("item C",)] == 1
    rules = baskets.association_rules(model, 0.9).collect()
    assert all(r["confidence"] > 0.9 for r in rules)
    keys = [(-r["confidence"], -r["lift"]) for r in rules]
    assert keys == sorted(keys)


@pytest.mark.parametrize("per_row", [0, 2, 1000])
@pytest.mark.parametrize("support", [0.05, 0.12, 0.5])
def test_itemsets_and_rules_equal_brute_force_by_either_way(spark, make_lines, support, per_row):
    rng = random.Random(4)
    by = {f"i{i}": {f"{rng.choice('ABCDEFGH')}" for _ in range(rng.randint(1, 7))} for i in range(60)}
    lines = [(name, code, 1, 1, "u", "2011-01-01") for name, codes in by.items() for code in sorted(codes)]
    model = baskets.frequent_itemsets(make_lines(*lines), support, 0.4, per_row=per_row)
    held = [codes for codes in by.values() if len(codes) >= 2]
    counts = Counter(c for codes in held for k in range(1, 9) for c in itertools.combinations([f"item {x}" for x in sorted(codes)], k))
    wanted = {c: n for c, n in counts.items() if n >= support * len(held)}
    rows = [(tuple(sorted(r["items"])), r["freq"]) for r in model.freqItemsets.collect()]
    assert len(rows) == len(wanted) and dict(rows) == wanted
    assert len(max(wanted, key=len)) >= (1 if support == 0.5 else 3)
    rules = {}
    for whole, n in wanted.items():
        for x in whole if len(whole) > 1 else ():
            left = tuple(y for y in whole if y != x)
            if n / wanted[left] >= 0.4:
                rules[left, x] = (n / wanted[left], n / wanted[left] / (wanted[x,] / len(held)), n / len(held))
    found = {(tuple(sorted(r["antecedent"])), *r["consequent"]): tuple(r)[2:] for r in model.associationRules.collect()}
    assert found.keys() == rules.keys()
    assert all(found[k] == pytest.approx(rules[k]) for k in rules)


def test_itemsets_and_rules_are_read_from_storage(sales):
    model = baskets.frequent_itemsets(sales, 0.3, 0.1)
    assert model.freqItemsets.inputFiles() and model.associationRules.inputFiles()
    none = baskets.frequent_itemsets(sales.limit(0), 0.3, 0.1)
    assert none.freqItemsets.count() == none.associationRules.count() == 0


def test_affinity_counts_each_pair_once_on_the_newest_invoices(make_lines):
    sales = make_lines(
        ("1", "A", 1, 1, "u", "2011-01-01"),
        ("1", "B", 1, 1, "u", "2011-01-01"),
        ("2", "A", 1, 1, "u", "2011-02-01"),
        ("2", "B", 1, 1, "u", "2011-02-01"),
        ("3", "A", 1, 1, "u", "2011-03-01"),
        ("3", "B", 1, 1, "u", "2011-03-01"),
        ("3", "C", 1, 1, "u", "2011-03-01"),
    )
    rows = {
        (r["Product1"], r["Product2"]): (r["CooccurrenceCount"], r["BundleScore"])
        for r in baskets.product_affinity(sales, last_invoices=2).collect()
    }
    assert rows == {("A", "B"): (2, 1.0), ("A", "C"): (1, 0.5), ("B", "C"): (1, 0.5)}
