"""Language identification: features, learner, calibration, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from marketloom.llm import language_id as lid

SYLLABLES = {"aa": ["ka", "to", "mi", "ru", "sen"], "bb": ["schu", "ber", "gen", "tz", "auf"], "cc": ["ció", "ñe", "la", "os", "mente"]}


def sentence(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def test_features_count_every_run_of_symbols_whatever_the_chunks(monkeypatch):
    rng = random.Random(3)
    text = " 12 Ab,ab  ÉCOLE\n" + sentence(rng, "cc", 60) + "!?"
    line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    grams = [line[i : i + n] for n in range(1, lid.LONGEST + 1) for i in range(len(line) - n + 1)]
    # The opening boundary alone is no n-gram of its own.
    at, counts = lid.term_counts(text)
    assert counts.sum() == len(grams) - 1
    assert len(at) == len(set(grams)), "no two of these n-grams share a feature"
    for size in (1, 2, 7, 50):
        monkeypatch.setattr(lid, "CHUNK", size)
        again = lid.term_counts(text)
        assert (again[0] == at).all() and (again[1] == counts).all()


def test_leader_follows_the_closed_form_of_every_weight():
    rng = np.random.default_rng(5)
    leader = lid.Leader(3, 4)
    z, n = np.zeros((3, 5)), np.zeros((3, 5))
    for _ in range(60):
        at = np.sort(rng.choice(5, size=3, replace=False))
        x, label = rng.random(3), int(rng.integers(3))
        leader.learn(at, x, label)
        w = np.zeros((3, 5))
        for c in range(3):
            for j in range(5):
                if abs(z[c, j]) > lid.L1:
                    w[c, j] = -(z[c, j] - math.copysign(lid.L1, z[c, j])) / ((lid.BETA + math.sqrt(n[c, j])) / lid.ALPHA + lid.L2)
        odds = [math.exp(sum(w[c, j] * v for j, v in zip(at, x, strict=True))) for c in range(3)]
        for c in range(3):
            error = odds[c] / sum(odds) - (c == label)
            for j, v in zip(at, x, strict=True):
                g = error * v
                z[c, j] += g - (math.sqrt(n[c, j] + g * g) - math.sqrt(n[c, j])) / lid.ALPHA * w[c, j]
                n[c, j] += g * g
    assert np.allclose(leader.sums.T, z) and np.allclose(leader.squares.T, n)


def test_temperature_lowers_the_log_loss_of_sure_answers():
    rng = np.random.default_rng(1)
    labels = rng.integers(2, size=400)
    sure = np.where(rng.random(400) < 0.8, labels, 1 - labels)
    logits = np.eye(2)[sure] * 9.0
    t = lid.temperature(logits, labels)
    chance = math.exp(9 / t) / (math.exp(9 / t) + 1)
    assert abs(chance - np.mean(sure == labels)) < 0.01
    assert lid.temperature(np.zeros((0, 2)), np.zeros(0, dtype=int)) == 1.0


def test_held_out_accuracy_on_the_samples(spark, sample_dir):
    docs = lid.table(spark, sample_dir, "documents")
    found = lid.op11(spark, sample_dir)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == docs.count()
    rows = found.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows_and_labels(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, lang, rng.randint(3, 30)), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(1000, None, "aa", "x"), (1001, "", "bb", "x"), (1002, "12 .. 34", "cc", "x"), (None, sentence(rng, "bb", 9), "bb", "x")]
    rows += [(1003, sentence(rng, "cc", 9), None, "x"), (5, rows[5][1], rows[5][2], "y"), (1004, sentence(rng, "aa", 60_000), "bb", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, held_out string")
    model = lid.learn(docs)
    assert model.languages == ("aa", "bb", "cc")
    assert 0 < np.mean(model.weights != 0) < 0.5, "the L1 penalty leaves most weights at 0"
    found = lid.identify(docs, model).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003]["lang_pred"] == "cc" and by[None]["lang_pred"] == "bb" and by[None]["held_out"] is False
    assert by[1004]["lang_pred"] == "aa"
    labels = {i: lang for i, _, lang, _ in rows[: 3 * 60]}
    assert all(by[i]["lang_pred"] == lang for i, lang in labels.items())


def test_predictions_see_the_text_alone(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, lang, 12), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    model = lid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    again = spark.createDataFrame([(10_000 - i, t, None) for i, t, _ in rows], "doc_id bigint, text string, lang string")
    scores = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lid.identify(again, model).collect()}
    for i, text, _ in rows:
        assert scores[10_000 - i] == model.predict(text)


def test_nothing_or_one_language_to_learn(spark):
    kinds = "doc_id bigint, text string, lang string"
    empty = spark.createDataFrame([], kinds)
    assert lid.identify(empty, lid.learn(empty)).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None), (2, "def", None)], kinds)
    assert {(r["lang_pred"], r["score"]) for r in lid.identify(unlabelled, lid.learn(unlabelled)).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(i, f"abc def {i}", "xx") for i in range(20)], kinds)
    assert {(r["lang_pred"], r["score"]) for r in lid.identify(one, lid.learn(one)).collect()} == {("xx", 1.0)}


def test_only_learning_rows_are_learned_from(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, "aa" if i % 2 else "bb", 8), "aa" if i % 2 else "bb") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    wrong = docs.withColumn("lang", F.when(lid.held_out(), F.lit("never")).otherwise(F.col("lang")))
    assert lid.learn(wrong).languages == ("aa", "bb")
    assert (lid.learn(wrong).weights == lid.learn(docs).weights).all()
