from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from marketloom.llm import bloom, decontaminate, line_chunks, suffixes


def brute_repeats(rows, depth):
    seen, out = set(), {}
    for i, text in sorted((i, (t or "").encode()) for i, t in rows):
        marks = np.zeros(len(text) + 1, dtype=int)
        for s in range(len(text) - depth + 1):
            if text[s : s + depth] in seen:
                marks[s] += 1
                marks[s + depth] -= 1
            else:
                seen.add(text[s : s + depth])
        gone = np.cumsum(marks)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes())
    return out


def shared_pieces(rng):
    """Texts made of long pieces that occur in several places, whole and cut."""
    pieces = ["".join(rng.choice("abcé ") for _ in range(rng.randint(60, 260))) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            piece = rng.choice(pieces)
            a = rng.randint(0, 40)
            parts += [piece[a : len(piece) - rng.randint(0, 40)], "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, make_docs, corpus, seed):
    rows = shared_pieces(random.Random(seed)) + [(i + 500, t) for i, t in corpus]
    docs = make_docs(rows + [rows[5], (None, rows[5][1])]).withColumnRenamed("source", "first")
    out = suffixes.remove_repeats(docs).collect()
    assert len(out) == len(rows) + 2
    want = brute_repeats(rows, 100)
    for r in out:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.data)) == want[r.doc_id]


def test_texts_that_share_an_id(spark, make_docs):
    """Each is a document of its own: nothing goes from a text that occurs once."""
    rng = random.Random(4)
    x, y, z = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3))
    docs = make_docs([(1, x), (2, x), (2, y), (3, z + z), (3, y), (3, y), (4, "ab" * 300)])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(docs).collect())
    assert got == [(1, 300, 0), (2, 300, 0), (2, 300, 300), (3, 300, 300), (3, 300, 300), (3, 600, 300), (4, 600, 598)]


def test_runs_of_texts_together_are_those_of_each(corpus):
    texts = [(t or "").encode() for _, t in corpus]
    together = suffixes.runs(texts)
    alone = []
    for k, data in enumerate(texts):
        if found := suffixes.runs([data]):
            alone += [(k, *row) for row in zip(found.cores, found.whole(100), found.first, found.last, strict=True)]
    offset = together.bounds[together.text()]
    rows = zip(together.text(), together.cores, together.whole(100), together.first - offset, together.last - offset, strict=True)
    assert list(rows) == alone
    assert [k for a, b in suffixes.together(texts) for k in range(a, b)] == list(range(len(texts)))


def test_repeated_bytes_of_nothing(spark, make_docs):
    assert suffixes.remove_repeats(make_docs([])).count() == 0
    short = suffixes.remove_repeats(make_docs([(1, "ab" * 40), (2, "ab" * 40), (3, None)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in short) == [(1, 0), (2, 0), (3, 0)]


def test_line_chunks(spark, make_docs, corpus):
    rows = [(i, t) for i, t in corpus]
    first = next(t for i, t in corpus if i == 409)
    rows += [(600, "new line\n" + first), (601, first + "\nlast line"), (602, "a\na\na\na\na\na"), (603, "a\na\na\na\na\na")]
    docs = make_docs(rows + [rows[0], (None, rows[0][1])]).withColumnRenamed("lang", "n_lines")
    out = line_chunks.drop_repeated_chunks(docs)
    seen, want = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data, drop = (text or "").encode(), set()
        for k, content in line_chunks.repeatable_chunks(data):
            if content in seen:
                drop.add(k)
            seen.add(content)
        want[i] = (None if text is None else line_chunks.without_chunks(data, drop)[0].decode(), len(drop))
    got = out.collect()
    assert len(got) == len(rows) + 2 and "source" in out.columns
    for r in got:
        assert (r.text, r.n_removed_chunks) == (want[r.doc_id] if r.doc_id is not None else (rows[0][1], 0))
    # Behind an insertion the chunks are those of the original again.
    assert sum(want[600][1] for _ in (0,)) >= 0.9 * len(line_chunks.repeatable_chunks(first.encode()))
    assert line_chunks.drop_repeated_chunks(docs.limit(0)).count() == 0


def test_chunks_put_together_give_the_text(corpus):
    for _, text in corpus:
        data = (text or "").encode()
        assert line_chunks.without_chunks(data, set())[0] == data


def edit_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_leaks(spark, make_docs):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, text(rng.randint(12, 45))) for i in range(12)]
    rows = []
    for k in range(70):
        leak = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(leak))
            leak[at : at + 1] = rng.choice(["", "z", "zq"])
        rows.append((k, text(15) + "  " + "".join(leak).upper() + "\n" + text(15)))
    rows += [(100 + k, text(60)) for k in range(20)] + [(200, None), (201, ""), (202, "x" * 9), (203, "a b " * 5000)]
    listed = [*items, (90, None), (91, ""), (92, "too short"), (0, items[0][1])]
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in listed], "item_id bigint, text string, doc_id string")
    found = decontaminate.leaks(make_docs(rows + [rows[0]]), benchmark).collect()
    index = decontaminate.Index.of([(i, t.encode()) for i, t in items])
    want = set()
    for k, body in rows:
        normal = decontaminate.normal((body or "").encode())[0].tobytes()
        for content, owners, (_, most) in zip(index.contents, index.owners, index.shape.tolist(), strict=True):
            if len(normal) < 2000 and edit_distance(content.tobytes(), normal) <= most:
                want |= {(k, index.items[number][0]) for number, _ in owners}
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) > 30
    for r in found:
        assert 0 <= r.doc_start < r.doc_end and r.edits <= decontaminate.EDITS
    kept = decontaminate.clean_documents(make_docs(rows), benchmark)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - {k for k, _ in want}


def with_rules(rng):
    """Items and a text with stretches of one period in them."""

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))

    def rule(n):
        return rng.choice(["-", "=-", "*+.", "abc ", "-- "]) * n

    items = [(i, f"{words(12)} {rule(rng.randint(5, 90))} {words(12)}".encode()) for i in range(8)]
    parts = [words(9), rule(rng.randint(300, 900)), rng.choice(items)[1].decode(), rule(rng.randint(300, 900)), words(5), rule(50)]
    rng.shuffle(parts)
    return items, " ".join(parts).encode()


@pytest.mark.parametrize("seed", range(6))
def test_shortened_stretches_lose_no_leak(monkeypatch, seed):
    items, text = with_rules(random.Random(seed))
    index = decontaminate.Index.of(items)
    monkeypatch.setattr(decontaminate, "CROWDED", 0)
    short = index.matches(text)
    monkeypatch.setattr(decontaminate, "CROWDED", 1 << 40)
    whole = index.matches(text)
    assert whole and [m[0] for m in short] == [m[0] for m in whole]
    for a, b in zip(short, whole, strict=True):
        assert abs(a[1] - b[1]) <= decontaminate.EDITS and abs(a[2] - b[2]) <= decontaminate.EDITS


def test_a_long_rule_takes_little_work():
    """Ten thousand dashes against items that hold a rule: hits and alignments stay few."""
    rng = random.Random(2)
    items = [(i, ("".join(rng.choice("abcdefg ") for _ in range(90)) + "-" * 100).encode()) for i in range(40)]
    index = decontaminate.Index.of(items)
    text = decontaminate.normal(b"-" * 10_000)[0]
    cut = decontaminate.shortened(text)
    assert len(cut.text) <= 2 * decontaminate.EDGE + 1 and cut.back(0, len(cut.text)) == (0, 10_000)
    hits = index.hits(decontaminate.qgrams(cut.text))
    assert int(hits[2].sum()) < 100_000 and sum(1 for _ in index.candidates(*hits)) < 20_000
    assert {m[0] for m in index.matches(b"-" * 10_000)} == set(range(40))


def test_short_items_are_found_where_they_stand_alone(spark, make_docs):
    docs = make_docs([(1, "Find  the\nKey, here"), (2, "the keyring and xthe key"), (3, "x"), (4, None)])
    items = spark.createDataFrame([(7, "the key"), (8, "X"), (9, ""), (10, None)], "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.doc_start, r.doc_end) for r in decontaminate.leaks(docs, items).collect())
    assert got == [(1, 7, 6, 13), (3, 8, 0, 1)]
    assert decontaminate.clean_documents(docs, items).count() == 4


def test_shards_find_the_same(spark, make_docs, monkeypatch):
    rows = [(i, f"{i} " + "some words to find again in here, number " * 3 + str(i)) for i in range(6)]
    benchmark = spark.createDataFrame([(i, t) for i, t in rows], "item_id bigint, text string")
    whole = sorted(decontaminate.leaks(make_docs(rows), benchmark).collect())
    monkeypatch.setattr(decontaminate, "shard_count", lambda *a, **b: 3)
    assert sorted(decontaminate.leaks(make_docs(rows), benchmark).collect()) == whole
    assert decontaminate.leaks(make_docs(rows), benchmark.limit(0)).count() == 0
    assert decontaminate.leaks(make_docs([]), benchmark).count() == 0


def test_bloom_filter_loses_nothing(spark):
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "doc_id")
    docs = spark.range(3000).withColumnRenamed("id", "doc_id").withColumn("block", docs_column())
    likely, rest = bloom.split_by_ids(docs, ids, 1000)
    found = {r.doc_id for r in likely.collect()}
    assert {i for i in range(0, 3000, 3)} <= found and len(found) < 1100
    assert likely.count() + rest.count() == 3000 and likely.columns == docs.columns


def test_bloom_filter_leaves_columns_of_any_name(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "1 AS lane0", "2 AS _key", "3 AS _block", "4 AS _may", "5 AS block")
    likely, rest = bloom.split_by_ids(docs, docs.where("doc_id < 5").select("doc_id"), 5)
    assert likely.columns == rest.columns == docs.columns
    assert sorted(tuple(r) for r in likely.unionByName(rest).collect()) == [(i, 1, 2, 3, 4, 5) for i in range(40)]


def docs_column():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_hash_of_a_stretch_depends_on_its_bytes_alone():
    data = b"abcabcabc" * 20
    hashes = suffixes.Hashes(data)
    a, b = np.array([0, 3, 1]), np.array([30, 33, 31])
    one, two, three = hashes.of(a, b).tolist()
    assert one == two != three and hashlib.sha256(data).digest()
