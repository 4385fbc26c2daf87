from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, line_chunks, near_dups, packing
from marketloom.llm.common import staged


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, make_docs, corpus):
    """Small tables with planted cases: copies, a leak, junk, toxic texts."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    plain = [(i, t) for i, t in corpus if t and 40 < len(t.split()) < 1000]
    item = " ".join(rng.choice(words) for _ in range(30))
    rows = plain + [(700, " ".join(rng.choice(words) for _ in range(60)) + " " + item)]
    labels = [(i, 1, 0) for i, _ in plain]
    for k in range(60):
        text = " ".join(rng.choice(words) for _ in range(80))
        kind = k % 3
        text = text if kind == 0 else text.replace(" ", "%%% ") if kind == 1 else text + " moron " + text
        rows.append((1000 + k, text))
        if k < 40:
            labels.append((1000 + k, int(kind != 1), int(kind == 2)))
    path = tmp_path_factory.mktemp("tables")
    make_docs(rows + [(800, None), (801, "")]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def results(spark, folder):
    """Every stage's result on that of the stage before, in the pipeline's order."""
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        out.append(staged(step(spark, out[-1], folder), name))
    return out


def test_stages():
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]


def test_quality_stage(results):
    docs, good = results[:2]
    columns = docs.columns
    ids = {r.doc_id for r in good.collect()}
    assert good.columns == columns
    wrong = [k for k in range(60) if (1000 + k in ids) != (k % 3 == 0)]
    assert wrong == [] and 700 in ids


def test_line_stage(results):
    docs, good, lines = results[:3]
    columns = docs.columns
    seen, want = set(), {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        data, drop = (r.text or "").encode(), set()
        for k, content in line_chunks.repeatable_chunks(data):
            if content in seen:
                drop.add(k)
            seen.add(content)
        clean = line_chunks.without_chunks(data, drop)[0].decode() if drop else r.text
        if not drop or clean.strip(" "):
            want[r.doc_id] = clean
    assert {r.doc_id: r.text for r in lines.collect()} == want and lines.columns == columns
    assert all(r.n_chars == len(r.text) for r in lines.collect() if r.text)


def test_near_stage(results):
    docs, _, lines, single = results[:4]
    columns = docs.columns
    groups = {r.doc_id: r.kept for r in near_dups.near_duplicates(lines).collect()}
    assert {r.doc_id for r in single.collect()} == {i for i, kept in groups.items() if kept}
    assert single.columns == columns


@pytest.mark.xfail(reason="line dedup leaves no near-duplicates in this fixture", strict=False)
def test_near_stage_has_work(results):
    groups = {r.doc_id: r.kept for r in near_dups.near_duplicates(results[2]).collect()}
    assert any(not kept for kept in groups.values())


def test_near_stage_drops_near_copies(spark, make_docs):
    """Texts of one line, which line dedup leaves alone."""
    words = [f"word{k}" for k in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(["changed", *words[1:]])), (3, " ".join(words[::-1]))]
    lines = corpus_pipeline.line_dedup(spark, make_docs(rows), "")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, lines, "").collect()) == [1, 3]


def test_decontamination_stage(results):
    docs, _, _, single, clean = results[:5]
    columns = docs.columns
    assert {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()} == {700}
    assert clean.columns == columns


def test_packing_stage(results):
    clean, packed = results[4], results[5].collect()
    kept = {r.doc_id: r.text or "" for r in clean.collect()}
    tokenizer = packing.TextTokenizer(packing.default_tokenizer()[0])
    ids = {i: t + (2).to_bytes(4, "little") for i, t in zip(kept, tokenizer.ids(list(kept.values())), strict=True)}
    got = {i: b"".join(bytes(r.ids) for r in sorted((r for r in packed if r.doc_id == i), key=lambda r: r.piece)) for i in kept}
    assert got == ids


def test_run_equals_the_stages(spark, folder, results):
    packed = results[5].collect()
    whole = {(r.doc_id, r.piece, r.start, r.length) for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {(r.doc_id, r.piece, r.start, r.length) for r in packed}


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert decontaminate.EDITS < decontaminate.Q


def test_columns_of_any_name_go_through(spark, folder):
    """The stages' own columns never stand in for those of the documents."""
    others = {"n_words": 77, "n_lines": 78, "verdict": 79, "lane0": 80, "_key": 81, "_may": 82}
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit(v) for c, v in others.items()})
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = staged(stage(spark, docs, folder), name)
        assert docs.columns[-len(others) :] == list(others)
        rows = docs.select(*others).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(others.values())]
