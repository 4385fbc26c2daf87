from __future__ import annotations

import itertools
import math
import random
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest

from marketloom import session
from marketloom.operators import similarity


def _brute(vectors, k):
    """Nearest neighbours by meeting every pair."""
    out = {}
    for a in vectors:
        scored = []
        for b in vectors:
            if a == b:
                continue
            shared = vectors[a].keys() & vectors[b].keys()
            if shared:
                dot = sum(vectors[a][f] * vectors[b][f] for f in shared)
                scored.append((-round(dot, 9), b))
        scored.sort()
        if scored:
            out[a] = [(b, -s) for s, b in scored[:k]]
    return out


def _unit(cells):
    out = {}
    for a, row in cells.items():
        norm = math.sqrt(sum(w * w for w in row.values()))
        out[a] = {f: w / norm for f, w in row.items()}
    return out


def _found(spark, vectors, k, limit):
    rows = [(a, f, w) for a, row in vectors.items() for f, w in row.items()]
    df = spark.createDataFrame(rows, "id STRING, f STRING, w DOUBLE")
    out = {}
    for r in sorted(similarity.nearest(df, k, limit).collect(), key=lambda r: (r["id"], r["rank"])):
        out.setdefault(r["id"], []).append((r["neighbour"], r["similarity"]))
    return out


def _random_cells(seed, ids, features, hot, copies=0):
    rng = random.Random(seed)
    cells = {}
    for i in range(ids):
        row = {f"f{rng.randrange(features)}": rng.randint(1, 50) / 10 for _ in range(rng.randint(0, 3))}
        for h in range(hot):
            if rng.random() < 0.6:
                row[f"hot{h}"] = rng.randint(1, 80) / 10
        if not row:
            row = {"hot0": 1.0}
        cells[f"c{i:03d}"] = row
    # Many equal customers: of one hot product, and of two.
    for i in range(copies):
        cells[f"x{i:03d}"] = {"hot0": 2.0} if i % 2 else {"hot0": 1.0, "hot1": 3.0}
    return cells


@pytest.mark.parametrize(
    ("seed", "hot", "copies", "limit"),
    [(1, 0, 0, 4096), (2, 1, 0, 8), (3, 1, 30, 30), (4, 3, 0, 20), (5, 3, 30, 8), (6, 2, 40, 3), (7, 3, 0, 4), (8, 2, 40, 1)],
)
@pytest.mark.parametrize("k", [1, 5])
def test_nearest_equals_brute_force(spark, seed, hot, copies, limit, k):
    vectors = _unit(_random_cells(seed, 60, 25, max(hot, 1), copies))
    expected = _brute(vectors, k)
    found = _found(spark, vectors, k, limit)
    assert found.keys() == expected.keys()
    for a, wanted in expected.items():
        assert [b for b, _ in found[a]] == [b for b, _ in wanted], a
        assert [s for _, s in found[a]] == pytest.approx([s for _, s in wanted], abs=1e-8)


def test_similarity_is_symmetric_and_in_range(spark):
    vectors = _unit(_random_cells(9, 40, 12, 1))
    found = _found(spark, vectors, 39, 2000)
    scores = {(a, b): s for a, row in found.items() for b, s in row}
    assert all(0 < s <= 1 for s in scores.values())
    assert all(scores[(b, a)] == s for (a, b), s in scores.items())


@pytest.mark.parametrize("per_cell", [0, 2, 5, 1000])
@pytest.mark.parametrize("limit", [8, 4096])
def test_joined_and_met_pairs_give_the_same_neighbours(spark, per_cell, limit):
    """Whether features are joined on, met in blocks, or some of both, neighbours are those of the brute force."""
    vectors = _unit(_random_cells(9, 60, 15, 3, copies=20))
    rows = [(a, f, w) for a, row in vectors.items() for f, w in row.items()]
    df = spark.createDataFrame(rows, "id STRING, f STRING, w DOUBLE")
    found = {}
    for r in sorted(similarity.nearest(df, 4, limit, per_cell).collect(), key=lambda r: (r["id"], r["rank"])):
        found.setdefault(r["id"], []).append((r["neighbour"], r["similarity"]))
    wanted = _brute(vectors, 4)
    assert {a: [b for b, _ in row] for a, row in found.items()} == {a: [b for b, _ in row] for a, row in wanted.items()}


def test_rows_sent_for_pairs_grow_with_the_cells(spark):
    """Ids whose features are rare are joined on these; no block is sent to any other."""
    rng = random.Random(5)
    for ids in (200, 800):
        rows = [(f"c{i}", f"f{f}", 1.0) for i in range(ids) for f in rng.sample(range(ids), 3)]
        cells = spark.createDataFrame(rows, "id STRING, f STRING, w DOUBLE")
        listed = similarity.joined_pairs(cells.selectExpr("*", "0D AS rest")).count()
        assert similarity.joined_on(cells, similarity.PAIRS_PER_CELL) > 3
        assert listed <= similarity.PAIRS_PER_CELL * len(rows)


def _in_groups(groups, size):
    """Ids that share features within their group, and one feature with everybody, of little weight."""
    rng = random.Random(11)
    cells = {}
    for g in range(groups):
        for i in range(size):
            row = {f"g{g:02d}_{f}": rng.randint(5, 9) / 1.0 for f in rng.sample(range(8), 5)}
            cells[f"c{g:02d}_{i:02d}"] = {**row, f"g{g:02d}": 20.0, "all": 0.5}
    return _unit(cells)


def test_block_pairs_under_the_bound_are_not_run(spark):
    vectors = _in_groups(groups=12, size=20)
    k, limit = 3, 60
    found = _found(spark, vectors, k, limit)
    wanted = _brute(vectors, k)
    assert {a: [b for b, _ in row] for a, row in found.items()} == {a: [b for b, _ in row] for a, row in wanted.items()}

    rows = [(a, f, w) for a, row in vectors.items() for f, w in row.items()]
    cells = spark.createDataFrame(rows, "id STRING, f STRING, w DOUBLE")
    homed = cells.join(similarity.in_blocks(cells, limit), "id")
    floors = spark.createDataFrame([(a, row[-1][1]) for a, row in wanted.items()], "id STRING, floor DOUBLE")
    blocks = homed.select("block").distinct().count()
    run = similarity.block_pairs(similarity.asking(homed, floors)).count()
    assert blocks > 20 and 0 < run < blocks * (blocks - 1) / 2 / 4


def test_no_block_has_more_than_its_cells_and_one_id(spark):
    vectors = _random_cells(3, 200, 40, 3, copies=50)
    rows = [(a, f, w) for a, row in vectors.items() for f, w in row.items()]
    rows += [("huge", f"f{i}", 1.0) for i in range(40)]
    cells = spark.createDataFrame(rows, "id STRING, f STRING, w DOUBLE")
    placed = similarity.in_blocks(cells, 25)
    sizes = {r["block"]: r["count"] for r in cells.join(placed, "id").groupBy("block").count().collect()}
    longest = max(len(row) for row in vectors.values())
    assert placed.count() == len(vectors) + 1 and sizes.pop(None) == 40
    assert max(sizes.values()) <= 25 + longest and len(sizes) <= -(-len(rows) // 25)


def test_identical_customers_are_neighbours_of_each_other(spark, make_lines):
    lines = make_lines(
        ("1", "A", 2, 5, "u", "2011-01-01"),
        ("2", "A", 2, 5, "v", "2011-01-02"),
        ("3", "B", 1, 5, "w", "2011-01-02"),
        ("3", "A", 1, 5, "w", "2011-01-02"),
    )
    near = similarity.customer_similarity(similarity.interactions(lines), 2).collect()
    pairs = {(r["CustomerID"], r["Neighbour"]) for r in near if r["Rank"] == 1}
    assert ("u", "v") in pairs and ("v", "u") in pairs
    assert all(r["CustomerID"] != r["Neighbour"] for r in near)


def test_minmax_uses_implicit_zeros(spark, make_lines):
    lines = make_lines(
        ("1", "A", 1, 10, "u", "2011-01-01"),
        ("2", "A", 3, 10, "v", "2011-01-01"),
        ("2", "B", 2, 10, "v", "2011-01-01"),
        ("3", "C", 1, 7, "u", "2011-01-01"),
        ("4", "C", 1, 7, "v", "2011-01-01"),
    )
    cells = similarity.minmax_scaled(similarity.interactions(lines)).collect()
    scaled = {(r["CustomerID"], r["StockCode"]): r["Scaled"] for r in cells}
    # Everybody bought A, so its minimum is a real one; B has an implicit zero; C does not vary.
    assert scaled == {
        ("u", "A"): 0.0,
        ("v", "A"): 1.0,
        ("v", "B"): 1.0,
        ("u", "C"): 0.0,
        ("v", "C"): 0.0,
    }


def test_recommendations_are_unseen_and_named_once(spark, make_lines):
    lines = make_lines(
        ("1", "A", 2, 5, "u", "2011-01-01"),
        ("2", "A", 2, 5, "v", "2011-01-02"),
        ("2", "B", 3, 4, "v", "2011-01-02", "red bag"),
        ("4", "B", 1, 6, "w", "2011-01-03", "RED BAG"),
        ("5", "C", 1, 6, "w", "2011-01-03"),
    )
    recs = similarity.neighbour_recommendations(lines).collect()
    assert all((r["CustomerID"], r["ProductStockCode"]) not in {("u", "A"), ("v", "A"), ("v", "B")} for r in recs)
    to_u = [r for r in recs if r["CustomerID"] == "u"]
    assert [r["ProductStockCode"] for r in to_u] == ["B"]
    assert to_u[0]["ProductDescription"] == "red bag"
    assert to_u[0]["ProductCategory"] == "red"
    assert to_u[0]["AveragePrice"] == pytest.approx(5.0)


@pytest.mark.parametrize("block_cells", [4, 4096])
def test_ties_within_rounding_go_by_id(spark, block_cells):
    """Similarities that differ behind the reported digits are equal, however the ids are dealt."""
    vectors = {f"c{i:02d}": {"x": 0.5 + i * 1e-11} for i in range(20)}
    found = _found(spark, vectors, 2, block_cells)
    assert [b for b, _ in found["c00"]] == ["c01", "c02"]
    assert [b for b, _ in found["c19"]] == ["c00", "c01"]


def test_similarity_that_rounds_to_zero_still_counts(spark):
    vectors = _unit({"a": {"x": 1.0, "z": 1e-7}, "b": {"y": 1.0, "z": 1e-7}, "c": {"x": 1.0}})
    found = _found(spark, vectors, 5, 4096)
    assert found["b"] == [("a", 0.0)]
    assert [b for b, _ in found["a"]] == ["c", "b"]


def test_best_unseen_equals_brute_force(spark):
    rng = random.Random(4)
    products = [f"p{i:02d}" for i in range(40)]
    cells = {(f"c{i:02d}", p): rng.randint(1, 9) * 10 for i in range(40) for p in rng.sample(products, rng.randint(1, 5))}
    cells |= {("huge", p): rng.randint(1, 9) * 10 for p in products}
    inter = spark.createDataFrame(
        [(c, p, s) for (c, p), s in cells.items()], "CustomerID STRING, StockCode STRING, Spend INT"
    ).selectExpr("CustomerID", "StockCode", "CAST(Spend AS DECIMAL(28,2)) AS Spend")
    near = similarity.customer_similarity(inter, 5)
    scores = {}
    for r in near.collect():
        for (c, p), spend in cells.items():
            if c == r["Neighbour"] and (r["CustomerID"], p) not in cells:
                key = (r["CustomerID"], p)
                scores[key] = scores.get(key, 0) + Decimal(repr(r["Similarity"])).quantize(Decimal("1e-9")) * spend
    wanted = {}
    for (c, p), score in scores.items():
        wanted.setdefault(c, []).append((-score, p))
    found = {}
    for r in sorted(similarity.best_unseen(near, inter, 4).collect(), key=lambda r: r["Rank"]):
        found.setdefault(r["CustomerID"], []).append((-r["Score"], r["StockCode"]))
    assert found == {c: sorted(rows)[:4] for c, rows in wanted.items()}


def test_with_descriptions_does_not_fan_out(spark):
    recs = spark.createDataFrame([("u", "A"), ("u", "Z")], "CustomerID STRING, ProductStockCode STRING")
    names = spark.createDataFrame([("A", "one"), ("A", "two")], "StockCode STRING, Description STRING")
    rows = similarity.with_descriptions(recs, names).collect()
    assert sorted((r["ProductStockCode"], r["Description"]) for r in rows) == [("A", "one"), ("Z", None)]


def test_brute_helper_orders_ties_by_id():
    vectors = _unit({"a": {"x": 1.0}, "b": {"x": 2.0}, "c": {"x": 3.0}})
    assert _brute(vectors, 2)["a"] == [("b", 1.0), ("c", 1.0)]
    assert len(list(itertools.combinations(vectors, 2))) == 3


def test_ids_that_meet_in_parts_find_the_same_neighbours(spark, monkeypatch):
    """Where features list much, ids are met part after part; no part's arrays hold those of another."""
    vectors = _unit(_random_cells(5, 60, 15, 0))
    rows = [(a, f, w) for a, row in vectors.items() for f, w in row.items()]
    cells = spark.createDataFrame(rows, "id STRING, f STRING, w DOUBLE")
    lists = similarity.feature_lists(cells)
    parts = [{(r["id"], r["other"]) for r in similarity.listed_sums(lists, i, 3).collect()} for i in range(3)]
    whole = {(r["id"], r["other"]) for r in similarity.listed_sums(lists).collect()}
    assert set.union(*parts) == whole and sum(map(len, parts)) == len(whole)
    assert all({a for a, _ in one}.isdisjoint(a for a, _ in other) for one, other in itertools.combinations(parts, 2))
    monkeypatch.setattr(similarity, "LISTED_AT_ONCE", 300)
    assert _found(spark, vectors, 3, 4096) == {a: [(b, pytest.approx(s, abs=1e-8)) for b, s in row] for a, row in _brute(vectors, 3).items()}


def test_unseen_items_shuffle_arrays_not_single_rows(spark):
    near = spark.createDataFrame([("u", "v", 0.5), ("u", "w", 0.25)], "CustomerID STRING, Neighbour STRING, Similarity DOUBLE")
    rows = [("u", "A", 1), ("u", None, 1), ("v", "A", 2), ("v", "B", 2), ("w", "B", 4), ("w", None, 4), ("x", "C", 9)]
    inter = spark.createDataFrame(rows, "CustomerID STRING, StockCode STRING, Spend INT")
    inter = inter.selectExpr("CustomerID", "StockCode", "CAST(Spend AS DECIMAL(28,2)) AS Spend")
    unseen = similarity.unseen_items(near, inter)
    # A product without a code is like no other, so nobody has it already.
    assert {(r["CustomerID"], r["StockCode"], float(r["Score"])) for r in unseen.collect()} == {("u", "B", 2.0), ("u", None, 1.0)}
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning(CustomerID" in line and "StockCode" in line.split("hashpartitioning")[1].split(")")[0]]


def test_best_unseen_in_parts_is_the_same(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(f"c{i:02d}", f"p{p}", rng.randint(1, 9)) for i in range(40) for p in rng.sample(range(30), 4)]
    inter = spark.createDataFrame(rows, "CustomerID STRING, StockCode STRING, Spend INT")
    inter = inter.selectExpr("CustomerID", "StockCode", "CAST(Spend AS DECIMAL(28,2)) AS Spend")
    links = [(f"c{i:02d}", f"c{j:02d}", rng.random()) for i in range(40) for j in rng.sample(range(40), 3) if i != j]
    near = spark.createDataFrame(links, "CustomerID STRING, Neighbour STRING, Similarity DOUBLE")
    whole = sorted(map(tuple, similarity.best_unseen(near, inter, 3).collect()))
    monkeypatch.setattr(similarity, "LISTED_AT_ONCE", 150)
    assert similarity.parts_for(len(links) * 4) > 1
    assert sorted(map(tuple, similarity.best_unseen(near, inter, 3).collect())) == whole


def test_unseen_items_of_many_customers_come_in_stored_parts(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(f"c{i:02d}", f"p{p}", rng.randint(1, 9)) for i in range(40) for p in rng.sample(range(30), 4)]
    inter = spark.createDataFrame(rows, "CustomerID STRING, StockCode STRING, Spend INT")
    inter = inter.selectExpr("CustomerID", "StockCode", "CAST(Spend AS DECIMAL(28,2)) AS Spend")
    links = [(f"c{i:02d}", f"c{j:02d}", rng.random()) for i in range(40) for j in rng.sample(range(40), 3) if i != j]
    near = spark.createDataFrame(links, "CustomerID STRING, Neighbour STRING, Similarity DOUBLE")
    whole = sorted(map(tuple, similarity.unseen_items(near, inter).collect()))
    monkeypatch.setattr(similarity, "LISTED_AT_ONCE", 150)
    found = similarity.unseen_items(near, inter)
    assert sorted(map(tuple, found.collect())) == whole
    # Nothing is left to send when the result is read.
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_recommendations_keep_no_intermediate_rows(spark, make_lines):
    lines = make_lines(*[(f"i{c}{p}", f"p{p}", p + 1, 2, f"c{c}", "2011-01-01") for c in range(4) for p in range(c, c + 3)])
    before = set(session._STORED)
    recs = similarity.neighbour_recommendations(lines)
    # The recommendations and the products' names.
    assert len(set(session._STORED) - before) == 2
    assert recs.count() > 0


@pytest.mark.parametrize("most_dense", [0, 256])
@pytest.mark.parametrize(("seed", "hot", "copies", "limit"), [(4, 3, 0, 20), (5, 3, 30, 8), (8, 2, 40, 1)])
def test_blocks_of_few_and_of_many_features_give_the_same_neighbours(spark, monkeypatch, most_dense, seed, hot, copies, limit):
    monkeypatch.setattr(similarity, "MOST_DENSE", most_dense)
    vectors = _unit(_random_cells(seed, 60, 25, hot, copies))
    found = _found(spark, vectors, 5, limit)
    assert {a: [b for b, _ in row] for a, row in found.items()} == {a: [b for b, _ in row] for a, row in _brute(vectors, 5).items()}


def _packed(vectors, names, k):
    """A block of these vectors, numbers as features and ids, which has met itself."""
    cells = {n: sorted(((w, f) for f, w in vectors[n].items()), reverse=True) for n in names}
    table = pa.table(
        {
            "id": pa.array(names, pa.int32()),
            "fs": pa.array([[f for _, f in cells[n]] for n in names], pa.list_(pa.int32())),
            "ws": pa.array([[w for w, _ in cells[n]] for n in names], pa.list_(pa.float64())),
            "floor": [0.0] * len(names),
        }
    )
    return similarity._dense_block(table, 0, 64, k)


def _numbered(seed, ids, groups):
    """Ids with all their weight on the features of their group but little, which lies on one of all."""
    rng = random.Random(seed)
    cells = {}
    for i in range(ids):
        own = rng.sample(range(6), 4)
        cells[i] = {i % groups * 6 + f: rng.randint(5, 9) / 1.0 for f in own} | {63: 0.1}
    return _unit(cells)


def test_dense_blocks_leave_out_what_bounds_rule_out(monkeypatch):
    vectors, k, products = _numbered(3, 6000, 10), 3, []
    times = similarity._Dense._products
    monkeypatch.setattr(similarity._Dense, "_products", staticmethod(lambda s, o, at, *x: products.append(len(s) * len(at)) or times(s, o, at, *x)))
    row, block = _packed(vectors, list(range(3000)), k)
    other, _ = _packed(vectors, list(range(3000, 6000)), k)
    products.clear()
    ours, theirs = similarity._Dense(row, 64, k), similarity._Dense(other, 64, k)
    theirs.as_columns(np.frombuffer(other["places"], dtype=np.int32))
    ours.meet(theirs)
    assert 0 < sum(products) < 3000 * 3000 / 2
    matrix = np.zeros((6000, 64))
    for i, cells in vectors.items():
        matrix[i, list(cells)] = list(cells.values())
    best = {}
    for table in (block.found(), ours.found()):
        for r in table.to_pylist():
            best.setdefault(r["id"], []).append((-r["similarity"], r["neighbour"]))
    for i in range(0, 3000, 7):
        sums = np.round(matrix @ matrix[i], 9)
        sums[i] = -1.0
        assert [b for _, b in sorted(best[i])[:k]] == np.lexsort((np.arange(6000), -sums))[:k].tolist()


def test_of_many_equal_ids_the_first_are_neighbours():
    """Ids with the same cells aren't all multiplied with each other."""
    vectors = {i: {0: 0.6, 1: 0.8} for i in range(2000)} | {i: {0: 0.8, 1: 0.6} for i in range(2000, 2003)}
    row, block = _packed(vectors, list(vectors), 2)
    assert len(row["places"]) // 4 == 3 + 3
    found = {}
    for r in block.found().to_pylist():
        found.setdefault(r["id"], set()).add((r["neighbour"], r["similarity"]))
    assert found[0] == {(1, 1.0), (2, 1.0)} and found[1] == {(0, 1.0), (2, 1.0)} and found[1999] == {(0, 1.0), (1, 1.0)}
    assert found[2002] == {(2000, 1.0), (2001, 1.0)}
