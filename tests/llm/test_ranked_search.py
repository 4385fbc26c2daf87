"""Ranked search against scores added up term by term, packing of postings, blocks left packed, odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from marketloom.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def brute_force(docs, items, k=20):
    counted = [(doc, Counter(TERM.findall((text or "").translate(UPPER)))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    total, terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = defaultdict(Counter)
    for item, text in items:
        wanted[item].update(TERM.findall((text or "").translate(UPPER)))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c in counted:
            m = 75 + (25 * sum(c.values()) * total) // terms
            score = 0
            for term, times in own.items():
                if c[term]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -score) for i, (score, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@given(st.lists(st.integers(0, 2**40), max_size=50))
def test_packing_is_reversible(values):
    data, sizes = rs.packed(np.array(values, dtype=np.int64))
    assert len(data) == sizes.sum()
    if values:
        assert rs.unpacked(data).tolist() == values


@pytest.mark.parametrize("segment", [1, 300, 1 << 21])
def test_equals_brute_force(spark, corpus, segment):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(3)
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice((corpus[j][1] or "x").split() or ["x"]) for j in rng.sample(range(len(corpus)), 12))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "ONE one, two!"), (53, "three"), (54, corpus[0][1]), (54, corpus[0][1])]
    found = rs.ranked_search(docs, spark.createDataFrame(items, "item_id bigint, text string"), segment_postings=segment)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == brute_force(corpus, items)


def test_odd_rows(spark):
    docs = [(3, "Été été A1 a1"), (1, "été"), (1, "été b"), (None, "été c d e"), (2, "x_y-z"), (7, "\x7f\x00"), (8, None)]
    items = [(0, "ÉTÉ été"), (None, "x y"), (1, "a1 z")]
    named = spark.createDataFrame([(*r, "s", 1, b"") for r in docs], "doc_id bigint, text string, segment string, term int, data binary")
    asked = spark.createDataFrame([(*r, 4) for r in items], "item_id bigint, text string, weight int")
    assert rows(rs.ranked_search(named, asked)) == brute_force(docs, items)
    none = named.limit(0)
    assert rs.ranked_search(none, asked).count() == 0 and rs.ranked_search(named, asked.limit(0)).count() == 0


def test_ties_beyond_k_go_by_id(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000 + i, f"other {i}") for i in range(300)]
    found = rs.ranked_search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), spark.createDataFrame([(1, "same")], "item_id bigint, text string"))
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == list(range(1, 21))


def test_more_items_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(rs, "BATCH_ITEMS", 3)
    docs = [(i, f"w{i % 7} w{i % 5} common") for i in range(60)]
    items = [(i, f"w{i} common") for i in range(10)]
    frames = (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(rs.ranked_search(*frames)) == brute_force(docs, items)


def test_long_text_in_steps(monkeypatch):
    text = "añb C,d " * 50
    whole = rs.term_counts(text.encode())
    assert rs.count_terms(text.encode()) == sum(whole.values()) == 150
    for size in (1, 3, 10):
        monkeypatch.setattr(rs, "CHUNK", size)
        assert rs.term_counts(text.encode()) == whole


def test_blocks_that_cannot_matter_stay_packed():
    rng = random.Random(6)
    segment = rs.Segment(20_000, 100_000)
    for i in range(20_000):
        rare = " rare" * (3 if i < 40 else 1) if i % 400 == 0 or i < 40 else ""
        segment.add(i, ("often " * rng.randint(1, 3) + "filler " * rng.randint(1, 4) + rare).encode())
    (lists, docs) = (b.to_pylist() for b in segment.rows("0"))
    work = Counter()
    weights = {b"often": 30, b"rare": 4000}
    own = [rs.PostingList(weights[r["term"]], r["most"], r["last"], r["top"], r["begin"], r["data"], work) for r in lists if r["term"] in weights]
    m = 75 + (25 * np.array(docs[0]["lengths"]) * 20_000) // 100_000
    places, scores = rs.best_in_segment(own, m, 20)
    blocks = sum(len(x.last) for x in own)
    assert work["blocks"] < blocks / 4

    whole = np.zeros(len(m), dtype=np.int64)
    for x in own:
        at, tf = x.within(0, len(m))
        whole[at] += x.weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[at]))
    order = np.argsort(-whole, kind="stable")[:20]
    assert places.tolist() == order.tolist() and scores.tolist() == whole[order].tolist()
