from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from marketloom.llm import graph, near_dups


def sets_of(rows, size):
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        width = min(size, len(words))
        out[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()
    return out


def brute(rows, size, percent):
    sets = sets_of(rows, size)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(rng, n, edits):
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(2000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((1000 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_equals_brute_force(spark, make_docs, corpus, size):
    rows = corpus + near_copies(random.Random(4), 60, 9)
    docs = make_docs(rows + [rows[2], rows[2], (None, "no id here at all"), (None, None)]).withColumnRenamed("lang", "rep")
    want = brute(rows, size, 80)
    out = near_dups.near_duplicates(docs, words=size).collect()
    assert len(out) == len(rows) + 4
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_blocks_find_what_stars_miss(spark, make_docs, monkeypatch):
    """With small blocks and no links from the stars, the blocks alone give the components."""
    monkeypatch.setattr(near_dups, "BLOCK", 3)
    rows = near_copies(random.Random(8), 30, 6)
    real, calls = near_dups._confirmed, []

    def no_star_links(pairs, *rest):
        calls.append(1)
        links = real(pairs, *rest)
        return links.limit(0) if len(calls) == 1 else links

    monkeypatch.setattr(near_dups, "_confirmed", no_star_links)
    want = brute(rows, 5, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(make_docs(rows)).collect()}
    # Pairs alone in a bucket are the stars' alone.
    large = {i for i, (_, c) in want.items() if sum(x[1] == c for x in want.values()) > 2}
    assert {i: got[i] for i in large} == {i: want[i] for i in large}


def test_empty_table(spark, make_docs):
    assert near_dups.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("size", [30, 150, 600, 4000])
def test_pruning_keeps_similar_pairs(size):
    rng = np.random.default_rng(size)
    left, right, sizes, similar = [], [], [], []
    for k in range(400):
        shared = int(size * (0.5 + 0.5 * rng.random()))
        own = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64) * np.uint64(2) + np.uint64(k % 2)
        one, other = np.unique(own[:size]), np.unique(np.concatenate([own[:shared], own[size : 2 * size - shared]]))
        left.append(near_dups.sketch(one)[1])
        right.append(near_dups.sketch(other)[1])
        sizes.append(len(one) + len(other))
        similar.append(shared / (2 * size - shared))
    matrix = [np.frombuffer(b"".join(x), dtype=np.uint8).reshape(-1, near_dups.BINS) for x in (left, right)]
    alive = set(near_dups.survives(*matrix, np.array(sizes), 0.8).tolist())
    assert {k for k, s in enumerate(similar) if s >= 0.8} <= alive
    assert not any(similar[k] < 0.6 for k in alive) or size < 100


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(80)]
    parent: dict[int, int] = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    edges = spark.createDataFrame([*pairs, (5, None), (None, None)], "a bigint, b bigint")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {i: root(i) for i in parent}
