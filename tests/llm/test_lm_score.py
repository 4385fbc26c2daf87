from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest

from marketloom.llm import lm_score


def small_vocabulary():
    names = [b" a", b" ab", b"b", b"ba", b"bab", b" ", b"a", b"c", *[bytes([x]) for x in range(256) if x not in b"abc "]]
    weights = np.append(np.arange(1, len(names) + 1, dtype=float), 5.0)
    return lm_score.Pieces((*names, b""), np.log(weights / weights.sum()))


def brute(pieces, word):
    chance = {n: math.exp(p) for n, p in zip(pieces.names[:-1], pieces.log_p, strict=False)}

    @cache
    def forward(at):
        if at == len(word):
            return 1.0
        return sum(chance[word[at:end]] * forward(end) for end in range(at + 1, len(word) + 1) if word[at:end] in chance)

    return math.log(forward(0))


WORDS = [b"abab", b"a", b"babab", b"c", b"abcab", b"\xc3\xa9a", b"abababababababab"]


def test_marginal_is_the_sum_over_segmentations():
    pieces = small_vocabulary()
    lattice = pieces.lattice()
    got = np.zeros(len(WORDS))
    for at, block in lm_score.blocks_of(WORDS):
        got[at] = lattice.marginal(block)
    assert np.allclose(got, [brute(pieces, b" " + w) for w in WORDS], atol=1e-12)


def test_expected_uses_are_the_derivative():
    pieces = small_vocabulary()
    into = np.zeros(len(pieces.names))
    for at, block in lm_score.blocks_of(WORDS):
        pieces.lattice().expected(block, np.ones(len(at)), into)
    for k in (0, 1, 2, 3, 6):
        moved = pieces.log_p.copy()
        moved[k] += 1e-6
        other = lm_score.Pieces(pieces.names, moved)
        slope = sum(brute(other, b" " + w) - brute(pieces, b" " + w) for w in WORDS) / 1e-6
        assert math.isclose(into[k], slope, rel_tol=1e-4, abs_tol=1e-4)


@pytest.mark.parametrize("hot_parts", [1, 50, lm_score.HOT_PARTS])
def test_rows(spark, make_docs, corpus, monkeypatch, hot_parts):
    """The share of words that go to every task changes nothing."""
    monkeypatch.setattr(lm_score, "HOT_PARTS", hot_parts)
    rows = corpus + [corpus[0]]
    docs = make_docs(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "word")
    counts: Counter = Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*(text or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    out = lm_score.score_texts(docs).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        words = [*(texts[r.doc_id] or "").encode().lower().split(), b""]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        assert -1e6 < r.score < 0


def test_model_scores_its_words(spark, make_docs):
    """Scores are the words' marginals under the re-estimated pieces; training raises held-out likelihood."""
    docs = make_docs([(i, "the cat sat on the mat again") for i in range(30)])
    vocabulary = lm_score.read_vocabulary(lm_score.default_vocabulary())
    counts = lm_score.word_counts(docs)
    pieces = vocabulary
    for _ in range(lm_score.STEPS):
        pieces = lm_score.reestimate(counts, pieces)
    want = sum(brute_fast(pieces, w) for w in b"the cat sat on the mat again".split()) + pieces.log_p[-1]
    before = sum(brute_fast(vocabulary, w) for w in b"the cat sat on the mat again".split()) + vocabulary.log_p[-1]
    got = {r.score for r in lm_score.score_texts(docs).collect()}
    assert all(math.isclose(s, want / math.log(10), rel_tol=1e-7) for s in got)
    assert want > before


def brute_fast(pieces, word):
    (_, block), *_ = lm_score.blocks_of([word])
    return float(pieces.lattice().marginal(block)[0])


def test_nothing_to_learn_from(spark, make_docs):
    out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = lm_score.score_texts(make_docs([(i, "a b") for i in out])).collect()
    assert [(r.n_known, r.train_tokens) for r in rows] == [(0, 0)] * 3
    assert lm_score.score_texts(make_docs([])).count() == 0
