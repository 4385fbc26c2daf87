from __future__ import annotations

import random

import pytest

from marketloom.llm import line_chunks


def runs_removed(rows):
    """Texts without the maximal runs of two or more lines that occur earlier, found line by line."""
    docs = {i: t.split("\n") for i, t in sorted(rows)}
    places, out = {}, {}
    for i, lines in docs.items():
        gone = set()
        for a, line in enumerate(lines):
            for d, b in places.get(line, []):
                n = 0
                while a + n < len(lines) and b + n < len(docs[d]) and lines[a + n] == docs[d][b + n]:
                    n += 1
                if n >= 2:
                    gone |= set(range(a, a + n))
            places.setdefault(line, []).append((i, a))
        out[i] = "\n".join(x for a, x in enumerate(lines) if a not in gone)
    return out


@pytest.mark.parametrize("length", [2, 3, 5, 8])
def test_no_line_of_a_shared_run_stays(spark, make_docs, length):
    """A run in fresh surroundings goes whole, whatever its length."""
    run = "\n".join(f"shared line {k} of {length}" for k in range(length))
    rows = [(i, "\n".join([*(f"{i} above {k}" for k in range(i % 4)), run, *(f"{i} below {k}" for k in range(i % 3))])) for i in range(30)]
    got = {r.doc_id: r.text for r in line_chunks.drop_repeated_chunks(make_docs(rows)).collect()}
    assert got[0] == rows[0][1]
    assert not any("shared" in text for i, text in got.items() if i)
    assert got == runs_removed(rows)


def test_equals_maximal_runs(spark, make_docs):
    rng = random.Random(5)
    lines = [f"line {k}" for k in range(150)]
    rows = []
    for i in range(80):
        chosen = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(lines))
            chosen += lines[at : at + rng.randint(1, 9)] if rng.random() < 0.6 else [f"own {i} {rng.random()}" for _ in range(rng.randint(1, 3))]
        # No line twice in a row: those have a rule of their own.
        rows.append((i, "\n".join(x for k, x in enumerate(chosen) if not k or chosen[k - 1] != x)))
    got = line_chunks.drop_repeated_chunks(make_docs(rows)).collect()
    want = runs_removed(rows)
    assert {r.doc_id: r.text for r in got} == want
    lost = {line for _, t in rows for line in t.split("\n")} - {line for t in want.values() for line in t.split("\n")}
    assert not lost


def test_equal_and_blank_lines(spark, make_docs):
    rows = [(1, "a\na\na"), (2, "x\n\na\na\na\n"), (3, "\np\n\nq\n"), (4, "p\n\nq"), (5, "p\nq"), (6, "r\np\n\nq\n\ns"), (7, "a\nx")]
    rows += [(8, "u\nv\nw\nu\nv"), (8, "k\nu\nv")]
    got = sorted((r.doc_id, r.text) for r in line_chunks.drop_repeated_chunks(make_docs(rows)).collect())
    assert got == [
        (1, "a\na"), (2, "x\n"), (3, "\np\n\nq\n"), (4, ""), (5, "p\nq"), (6, "r\n\ns"), (7, "a\nx"),
        (8, "k"), (8, "u\nv\nw"),
    ]


def test_boundaries_resist_shifts():
    """Two lines into a shared run the boundaries are the same, whatever stands before it."""
    rng = random.Random(9)
    run = [b"shared %d" % rng.randrange(10**9) for _ in range(400)]
    for divisor in line_chunks.DIVISORS:
        alone = line_chunks.boundaries(run, divisor)
        for k in range(20):
            above = [b"above %d %d" % (k, i) for i in range(k)]
            assert line_chunks.boundaries(above + run, divisor)[k + 1 :] == alone[1:]
        share = sum(alone) / len(alone)
        assert 0.8 / divisor <= share <= 1.2 / divisor


def test_every_pair_lies_in_one_chunk():
    rng = random.Random(3)
    for _ in range(200):
        data = "\n".join(rng.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(rng.randrange(30))).encode()
        pairs = len(line_chunks.repeatable_chunks(data))
        chunks = line_chunks.line_chunks(data, line_chunks.DIVISORS[0], set())
        assert [p for k, m, _ in chunks for p in range(k, m)] == list(range(pairs))
        assert all(content in data for _, _, content in chunks)


def test_whole_chunks_take_most_of_a_long_run():
    """Pairs are left for the ends of a repeated run only."""
    run = "\n".join(f"shared line {k}" for k in range(100))
    first = [{"content": c, "own": -1} for _, _, c in line_chunks.line_chunks(f"x\n{run}\ny".encode(), 4, set())]
    taken = line_chunks.later_pairs(f"p\nq\nr\n{run}\nz".encode(), 4, set(), first)
    assert len(taken) >= 80


def test_rows_of_random_lines_as_pairs(spark, make_docs):
    """Few different lines, blanks and rows of equal lines: what goes is what the pairs of lines say."""
    rng = random.Random(13)
    rows = [(i, "\n".join(rng.choice("abcdefgh" if i % 2 else ["a", "a", "b", "", " "]) for _ in range(rng.randrange(40)))) for i in range(60)]
    seen, want = set(), {}
    for i, text in rows:
        data, drop = text.encode(), set()
        for k, content in line_chunks.repeatable_chunks(data):
            if content in seen:
                drop.add(k)
            seen.add(content)
        want[i] = (line_chunks.without_chunks(data, drop)[0].decode(), len(drop))
    got = line_chunks.drop_repeated_chunks(make_docs(rows)).collect()
    assert {r.doc_id: (r.text, r.n_removed_chunks) for r in got} == want
