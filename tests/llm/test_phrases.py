"""Phrases against all n-grams counted, whatever the sample misses; scores in exact numbers; odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from marketloom.llm import phrases as ph

UPPER = {i: i + 32 for i in range(65, 91)}


def all_counts(docs, longest=5):
    counts, sizes = Counter(), Counter()
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang or "und", " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
    return counts, sizes


def brute_force(docs, least, percent=100, best=2000):
    counts, sizes = all_counts(docs)
    frequent = {p: f for p, f in counts.items() if f >= least}
    out = {}
    for (lang, phrase), a in frequent.items():
        w = phrase.split(" ")
        if len(w) < 2:
            continue
        over = [f for (other, longer), f in frequent.items() if other == lang and len(longer) > len(phrase) and f" {phrase} " in f" {longer} "]
        if any(100 * f >= percent * a for f in over):
            continue
        n, cuts = sizes[lang], []
        for k in range(1, len(w)):
            left, right = counts[lang, " ".join(w[:k])], counts[lang, " ".join(w[k:])]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), (phrase, a, left, right, n, score)))
    return sorted((lang, i + 1, *row[-1]) for lang, rows in out.items() for i, row in enumerate(sorted(rows)[:best]))


def made_up(seed, docs=60):
    rng = random.Random(seed)
    words = ["the", "of", "new", "york", "city", "hall", "ñu", "x", "y", "z", "it's", "b2"]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", " "]) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "de", None])))
    # Runs in one document are what a sample misses.
    rows += [(500 + i, f"only{i} " * 30 + f"here{i} and there{i} " * 12, "en") for i in range(6)]
    rows += [(600, None, "en"), (601, "", "de"), (602, " \t ", None), (None, "new york city hall " * 5, "en"), (3, rows[3][1], rows[3][2])]
    return rows


@pytest.mark.parametrize(("seed", "least", "sample"), [(1, 4, 8), (2, 9, 3), (3, 4, 1), (4, 12, 50)])
def test_equals_brute_force(spark, seed, least, sample):
    rows = made_up(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    frequent, sizes, passes = ph.frequent_phrases(docs, least=least, sample=sample)
    counts, totals = all_counts(rows)
    assert {(r["lang"], r["phrase"]): r["f"] for r in frequent.collect()} == {p: f for p, f in counts.items() if f >= least}
    assert frequent.count() == sum(f >= least for f in counts.values()), "nothing is counted in two passes"
    assert {r["lang"]: r["n"] for r in sizes.collect()} == {k: v for k, v in totals.items() if v}
    assert sample == 1 or passes == 2
    assert sorted(tuple(r) for r in ph.collocations(frequent, sizes).collect()) == brute_force(rows, least)


def test_sections_and_steps_do_not_change_counts(spark, monkeypatch):
    rows = made_up(7, docs=20)
    counts, _ = all_counts(rows)
    wanted = {p: f for p, f in counts.items() if f >= 3}
    for section, chunk in ((7, 3), (64, 1)):
        words = {lang: ph.Words(lang) for lang in ("en", "de", "und")}
        monkeypatch.setattr(ph, "SECTION", section)
        monkeypatch.setattr(ph, "CHUNK", chunk)
        for _, text, lang in rows:
            words[lang or "und"].add((text or "").encode())

        class Everything:
            def hits(self, keys):
                return keys == keys

        found = Counter()
        for own in words.values():
            for batch in ph.Pass((1, 2, 3, 4, 5), Everything(), None, False).rows(own):
                for r in batch.to_pylist():
                    if r["words"]:
                        found[r["lang"], r["phrase"]] += r["f"]
        assert {p: f for p, f in found.items() if f >= 3} == wanted and sum(found.values()) == sum(counts.values())


def test_products_beyond_64_bits(spark):
    big = 10**15
    frequent = spark.createDataFrame(
        [("en", "a b", 2, 7 * 10**13 + 3), ("en", "a", 1, 9 * 10**14 + 1), ("en", "b", 1, 8 * 10**14 + 7)], "lang string, phrase string, words int, f bigint"
    )
    sizes = spark.createDataFrame([("en", big + 9)], "lang string, n bigint")
    row = ph.collocations(frequent, sizes).first()
    assert row["score"] == 1000 * (7 * 10**13 + 3) * (big + 9) // ((9 * 10**14 + 1) * (8 * 10**14 + 7))


def test_cut_tie_goes_to_the_smallest_k(spark):
    rows = [(i, "a b c.", "en") for i in range(5)]
    frequent, sizes, _ = ph.frequent_phrases(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), least=5, sample=1)
    found = [tuple(r) for r in ph.collocations(frequent, sizes).collect()]
    assert found == [("en", 1, "a b c", 5, 5, 5, 15, 3000)]


def test_extra_columns_and_empty_tables(spark):
    kinds = "doc_id bigint, text string, lang string, phrase string, f int, id string, data int"
    docs = spark.createDataFrame([(1, "a b a b", "en", "p", 1, "i", 2)], kinds)
    frequent, sizes, _ = ph.frequent_phrases(docs, least=2, sample=1)
    assert {(r["phrase"], r["f"]) for r in frequent.collect()} == {("a", 2), ("b", 2), ("a b", 2)}
    frequent, sizes, _ = ph.frequent_phrases(docs.limit(0))
    assert ph.collocations(frequent, sizes).count() == 0
