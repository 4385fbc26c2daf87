from __future__ import annotations

from math import comb

import numpy as np
import pytest

from marketloom.llm import near_dups


def exact_tail(union, differ, seen, found):
    ways = sum(comb(differ, k) * comb(union - differ, seen - k) for k in range(found, min(differ, seen) + 1))
    return ways / comb(union, seen)


def test_bound_is_above_the_tail_and_close():
    cases = [
        (u, d, n, k)
        for u in (1, 2, 5, 9, 30, 77, 200, 1500, 4000)
        for d in sorted({0, u // 9, u // 5, u // 2, u})
        for n in sorted({0, min(u, 5), u // 8, u // 2, u})
        for k in sorted({0, *range(max(0, n * d // u - 1), min(n, d) + 2, 1 + n // 12)})
    ]
    got = np.exp(near_dups.log_tail(*(np.array(c, dtype=np.int64) for c in zip(*cases, strict=True))))
    want = np.array([exact_tail(*c) if c[3] <= c[1] else 0.0 for c in cases])
    assert (got >= want * (1 - 1e-7)).all()
    small = want < 1e-5
    assert small.sum() > 50 and (got[small] <= 3 * want[small]).all()


def test_few_bins_without_a_match_are_no_proof():
    left, right = np.zeros((2, 1, near_dups.BINS), dtype=np.uint8)
    left[0, :5], right[0, :5] = 1, 2
    assert near_dups.survives(left, right, np.array([72]), 0.8).tolist() == [0]


@pytest.mark.parametrize("union", [10, 20, 30, 40, 80, 100, 150, 200])
def test_pairs_at_the_threshold_are_not_missed(union):
    """Random signatures of pairs at exactly 0.8; the normal bound dropped up to 2e-4 of them."""
    rng, pairs, kept = np.random.default_rng(union), 200_000, 0
    for _ in range(0, pairs, 20_000):
        n = 20_000
        hashes = rng.integers(0, 1 << 24, (n, union))
        owner = np.zeros((n, union), dtype=np.int64)
        owner[:, : union // 10] = 1
        owner[:, union // 10 : union // 5] = 2
        order = np.argsort(hashes, axis=1)
        hashes, owner = np.take_along_axis(hashes, order, 1), np.take_along_axis(owner, order, 1)
        sides = []
        for away in (2, 1):
            signature = np.zeros((n, near_dups.BINS), dtype=np.uint8)
            rows = np.arange(n)
            for k in range(union - 1, -1, -1):
                has = owner[:, k] != away
                signature[rows[has], hashes[has, k] >> 15] = np.maximum(hashes[has, k] & 0xFF, 1)
            sides.append(signature)
        kept += len(near_dups.survives(*sides, np.full(n, 2 * union - union // 5), 0.8))
    # At 1e-6 a pair, two or more missed ones among these have a probability of 2 %.
    assert pairs - kept <= 1
