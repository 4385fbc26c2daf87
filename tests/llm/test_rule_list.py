from __future__ import annotations

import numpy as np

from marketloom.llm import quality


def caught(rules, matrix, names):
    found = np.zeros(len(matrix), dtype=bool)
    for rule in rules:
        found |= quality._covered(rule, matrix, names)
    return found


def test_a_class_with_a_period_of_three_gets_its_rule():
    """All bad rows have numbers k with k % 3 == 2."""
    rng = np.random.default_rng(1)
    matrix = rng.random((120, 2))
    bad = np.arange(120) % 3 == 2
    matrix[bad, 1] += 2
    names = ["words", "listed_words"]
    assert (caught(quality.learn_list(matrix, bad, names), matrix, names) == bad).all()
    ids = np.arange(120) * 3 + 7
    assert (caught(quality.learn_list(matrix, bad, names, ids=ids), matrix, names) == bad).all()


def test_an_imprecise_rule_does_not_end_the_list():
    """Most bad rows can't be told from good ones; a few of another kind can, and were never reached."""
    names, share = ["words", "mean_word", "symbol_share"], []
    for seed in range(5):
        rng = np.random.default_rng(seed)
        matrix = rng.random((400, 3))
        vague, plain = np.arange(400) < 60, np.arange(400) >= 388
        matrix[vague, 0] += 0.5
        matrix[plain, 2] += 2
        bad = (matrix[:, 1] > 0.55) & (rng.random(400) < 0.6) | plain
        matrix[plain, 2] = rng.random(12) * 0.2 + 0.4
        matrix[plain, 0] = 1.7
        found = caught(quality.learn_list(matrix, bad, names), matrix, names)
        share.append(found[plain].mean())
        assert found[~bad].mean() < 0.03
    assert np.mean(share) > 0.8


def test_learning_ends_where_no_rule_is_precise():
    rng = np.random.default_rng(4)
    matrix = rng.integers(0, 2, (300, 2)).astype(float)
    assert quality.learn_list(matrix, rng.random(300) < 0.3, ["words", "mean_word"]) == []
