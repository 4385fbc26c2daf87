from __future__ import annotations

import random

import pytest

from marketloom.llm.common import drop_staged, ready

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module", autouse=True)
def _no_leftovers(spark):
    ready(spark)
    yield
    drop_staged(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with the other columns filled in."""

    def build(pairs):
        rows = [(i, t, None if t is None else "en", "src0", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture(scope="session")
def corpus():
    """Invented texts: plain, exact and near copies, shared passages, short, empty, null, long, odd white space."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def text(n):
        out = []
        for k in range(n):
            out.append(rng.choice(words))
            out.append("\n" if k % 9 == 8 else " ")
        return "".join(out).strip()

    rows = [(i, text(rng.randint(5, 140))) for i in range(40)]
    passage = text(45)
    rows += [(100 + i, f"{text(20)}\n{passage}\n{text(20)}") for i in range(6)]
    rows += [(200 + i, rows[3][1]) for i in range(4)]
    base = text(120).split(" ")
    for i in range(8):
        near = list(base)
        near[10 * i] = "changed"
        rows.append((300 + i, " ".join(near)))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one two three"), (405, "ONE two three")]
    rows += [(406, "é\u00a0ö word\tx " * 30), (407, "for " * 3000), (408, "x" * 5000), (409, text(4000))]
    return rows
