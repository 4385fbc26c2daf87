from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from marketloom.llm import packing


def brute_bins(counts, capacity):
    bins = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in bins if r >= length]
            if fits:
                bins[bins.index(min(fits))] -= length
            else:
                bins.append(capacity - length)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_piece_by_piece(seed):
    rng = random.Random(seed)
    for _ in range(30):
        capacity = rng.choice([1, 7, 16, 33])
        counts = {n: rng.randint(1, 9) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
        plan = packing.best_fit_decreasing(counts, capacity)
        length = np.concatenate([np.full(n, size) for size, n in counts.items()])
        rank = np.concatenate([np.arange(n) for n in counts.values()])
        bins, offsets = plan.place(length, rank)
        fill: dict[int, int] = {}
        for at, offset, size in sorted(zip(bins, offsets, length, strict=True)):
            assert fill.get(at, 0) == offset
            fill[at] = offset + size
        assert sorted(capacity - f for f in fill.values()) == brute_bins(counts, capacity)


def test_quick_ids_are_the_tokenizers_ids(corpus):
    path, ranks = packing.default_tokenizer()
    texts = [t for _, t in corpus if t is not None] + ["<|endoftext|> a", "привет 日本", "a\tb", "'ll don't\n\n x  y"]
    assert packing.TextTokenizer(path, ranks).ids(texts) == packing.TextTokenizer(path).ids(texts)


def test_names_of_special_tokens_are_those_tokens():
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endof text|>", "<|endoftext", "é <|endoftext|>"]
    path, ranks = packing.default_tokenizer()
    plain = Tokenizer.from_file(path)
    for quick in (None, ranks):
        found = packing.TextTokenizer(path, quick).ids(texts)
        for text, ids in zip(texts, found, strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids


def test_pieces_and_places(spark, make_docs, corpus):
    rows = corpus + [corpus[0]]
    docs = make_docs(rows).withColumnRenamed("lang", "sequence_id")
    packed = packing.pack(docs).toPandas()
    tokenizer = packing.TextTokenizer(packing.default_tokenizer()[0])
    expected = []
    for (i, _), ids in zip(rows, tokenizer.ids([t or "" for _, t in rows]), strict=True):
        ids += np.array([2], dtype="<u4").tobytes()
        n = len(ids) // 4
        first = n % 1024 or 1024
        edges = [0, *range(first, n + 1, 1024)]
        expected += [(i, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    got = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in packed.itertuples()]
    assert sorted(got) == sorted(expected)
    ordered = packed.sort_values(["sequence_id", "offset"])
    for _, part in ordered.groupby("sequence_id"):
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]]
        assert part.length.sum() <= 1024
    assert packed.sequence_id.nunique() <= -(-packed.length.sum() // 1024) + 1


def test_empty_table(spark, make_docs):
    assert packing.pack(make_docs([])).count() == 0
