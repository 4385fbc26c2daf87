"""Quality rules: a learned decision list over text statistics.

Sequential covering: on labelled statistics a conjunction of threshold conditions is grown condition by
condition (information gain), pruned on rows held back (a third of each class by a hash of the id, dealt anew
for every rule), and kept while it stays precise; the rows it covers leave and the next rule is learned. Where neither
the pruned nor the grown rule is precise, the bad rows it was grown for are set aside and the others go on. The list comes out as ordered conditions that Spark
evaluates as one CASE expression, the last entry keeping everything else.

The labelled rows for fitting are bounded (``FIT_ROWS``, taken in hash order of the id); statistics are
computed for every document over its whole text. Among the statistics is the number of words of a
lexicon: at most ``LEXICON_WORDS`` words that labelled toxic documents hold far more often than others.

Defined cases: null text counts as no words; documents without a label are judged by the same list; no
labels or one class only gives an empty list, which keeps all; a document with several labels is bad if
one of them says so; repeated rows are judged alike; columns named like a statistic are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import mix64, ready, table, utf8, words_of

FIT_ROWS = 20_000
LEXICON_WORDS = 256

STATISTICS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_upper",
    "n_letters",
    "n_digits",
    "n_marks",
    "n_bare_words",
    "n_listed_words",
]
#: What conditions test: counts as they are or as shares, by name.
RATIOS = {
    "words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "n_words"),
    "bare_share": ("n_bare_words", "n_words"),
    "listed_words": ("n_listed_words", None),
}

_SPACE = b" \t\n\x0b\x0c\r"
_TAILS = bytes(range(0x80, 0xC0))
_ASCII_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTER_RUN = re.compile(rb"[A-Za-z\x80-\xff]+")


def _without(data: bytes, drop: bytes) -> int:
    return len(data.translate(None, drop))


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows that occur twice or more in the text, all occurrences counted."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    keys = numbers[: n - window + 1]
    for step in range(1, window):
        # Dense again after each word, so that the product never overflows.
        _, keys = np.unique(keys * len(ids) + numbers[step : n - window + 1 + step], return_inverse=True)
    often = np.bincount(keys)[keys] > 1
    covered = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(often)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:n])))


def text_statistics(data: bytes, listed: frozenset[bytes] = frozenset()) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    words = words_of(data)
    n_lines = n_dup = 0
    seen = set()
    for line in data.split(b"\n"):
        if line.strip(_SPACE):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    size = len(data)
    letters = size - _without(data, _ASCII_LETTERS)
    n_listed = 0
    if listed:
        n_listed = sum(run in listed for run in _LETTER_RUN.findall(data.lower()))
    distinct = set(words)
    bare = 0
    if distinct:
        without = {w for w in distinct if not _LETTER_RUN.search(w)}
        bare = sum(w in without for w in words) if without else 0
    return (
        len(words),
        _without(data, _SPACE + _TAILS),
        size - _without(data, b"#*$%&|<>"),
        n_dup,
        repeated_words(words),
        n_lines,
        len(distinct),
        size - _without(data, _ASCII_LETTERS[26:]),
        letters,
        size - _without(data, b"0123456789"),
        size - _without(data, b"!?"),
        bare,
        n_listed,
    )


def add_statistics(docs: DataFrame, listed: frozenset[bytes] = frozenset(), text: str = "text") -> DataFrame:
    """The documents with a long column for each statistic."""
    kept = [c for c in docs.columns if c not in STATISTICS]
    schema = docs.select(*kept).schema
    source = docs.select(*kept, utf8(text).alias("_utf8"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_statistics(v, listed) for v in batch.column(len(kept)).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in columns]],
                names=[*batch.schema.names[:-1], *STATISTICS],
            )

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return source.mapInArrow(step, ", ".join(filter(None, [out, *[f"{s} bigint" for s in STATISTICS]])))


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


# ------------------------------------------------------------------ learning


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def expression(self) -> Column:
        value = ratio(self.name)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, matrix: np.ndarray, names: list[str]) -> np.ndarray:
        values = matrix[:, names.index(self.name)]
        return values > self.threshold if self.above else values <= self.threshold


Rule = tuple[Condition, ...]


def _covered(rule: Rule, matrix: np.ndarray, names: list[str]) -> np.ndarray:
    inside = np.ones(len(matrix), dtype=bool)
    for condition in rule:
        inside &= condition.holds(matrix, names)
    return inside


def _grow(matrix: np.ndarray, bad: np.ndarray, names: list[str], most: int) -> Rule:
    """Add the condition with the highest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < most and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        base, best, gain = np.log2(p / (p + n)), None, 1e-9
        for j, name in enumerate(names):
            values = matrix[inside, j]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, 65)))
            order = np.argsort(values, kind="stable")
            upto = np.searchsorted(values[order], cuts, side="right")
            below_bad = np.concatenate([[0], np.cumsum(bad[inside][order])])[upto]
            for above, pos, size in ((False, below_bad, upto), (True, p - below_bad, len(values) - upto)):
                ok = (pos > 0) & (size < len(values))
                gains = np.where(ok, pos * (np.log2(np.maximum(pos, 1) / np.maximum(size, 1)) - base), -1.0)
                k = int(np.argmax(gains)) if len(gains) else 0
                if len(gains) and gains[k] > gain:
                    gain, best = gains[k], Condition(name, above, float(cuts[k]))
        if best is None:
            break
        rule = (*rule, best)
        inside &= best.holds(matrix, names)
    return rule


def _prune(rule: Rule, matrix: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    """Drop last conditions while that doesn't lower (p - n) / (p + n) on rows held back."""

    def worth(candidate: Rule) -> float:
        inside = _covered(candidate, matrix, names)
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def _held_back(hashes: np.ndarray, bad: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """Every third row of each class in hash order; a class with a row left always has one that isn't held back."""
    held = np.zeros(len(bad), dtype=bool)
    for kind in (True, False):
        rows = np.flatnonzero((bad == kind) & ~aside)
        held[rows[np.argsort(hashes[rows], kind="stable")][2::3]] = True
    return held


def learn_list(
    matrix: np.ndarray,
    bad: np.ndarray,
    names: list[str],
    min_precision: float = 0.97,
    min_cover: int = 4,
    most_rules: int = 24,
    most_conditions: int = 4,
    ids: np.ndarray | None = None,
) -> list[Rule]:
    """Ordered rules that reject; rows no rule covers are kept. ``ids`` (row numbers by default) deal rows out."""
    rules: list[Rule] = []
    hashes = mix64((np.arange(len(bad)) if ids is None else np.asarray(ids)).astype(np.uint64))
    matrix_left, bad_left = matrix, bad
    # Bad rows that led to an imprecise rule: they count, but no rule is grown for them.
    aside = np.zeros(len(bad), dtype=bool)
    misses = 0
    while max(len(rules), misses) < most_rules and (bad_left & ~aside).any() and (~bad_left).any():
        held_left = _held_back(hashes, bad_left, aside)
        growing = ~held_left & ~aside
        grown = _grow(matrix_left[growing], bad_left[growing], names, most_conditions)
        pruned = _prune(grown, matrix_left[held_left], bad_left[held_left], names)
        if not grown:
            break
        for rule in dict.fromkeys((pruned, grown)):
            inside = _covered(rule, matrix_left, names)
            caught = bad_left[inside]
            if len(caught) >= min_cover and caught.mean() >= min_precision:
                rules.append(rule)
                matrix_left, bad_left, hashes, aside = (x[~inside] for x in (matrix_left, bad_left, hashes, aside))
                break
        else:
            aside |= bad_left & _covered(grown, matrix_left, names)
            misses += 1
    return rules


def keep_expression(rules: list[Rule]) -> Column:
    """The decision list as one CASE expression: false at the first rule that holds, else true."""
    verdict = None
    for rule in rules:
        holds = reduce(lambda a, b: a & b, (c.expression() for c in rule))
        verdict = F.when(holds, F.lit(False)) if verdict is None else verdict.when(holds, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents in hash order of the id: doc_id, text, bad, toxic."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
        .groupBy("doc_id")
        .agg(
            (F.coalesce(F.min("quality") == 0, F.lit(False)) | F.coalesce(F.max("toxic") == 1, F.lit(False))).alias("bad"),
            F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic"),
        )
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # The labels are bounded by ``rows``, so sending them to every task is.
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def learn_lexicon(sample: DataFrame, words: int = LEXICON_WORDS, support: int = 5, odds: float = 20.0) -> frozenset[bytes]:
    """Words found in many toxic documents and hardly in others, at most ``words`` of them."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        sizes = {True: 0, False: 0}
        for batch in batches:
            for data, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sizes[toxic] += 1
                counts[toxic].update(set(_LETTER_RUN.findall(data.lower())))
        found = list(counts[True] | counts[False])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *found], pa.binary()),
                pa.array([sizes[True], *[counts[True][w] for w in found]], pa.int64()),
                pa.array([sizes[False], *[counts[False][w] for w in found]], pa.int64()),
            ],
            names=["word", "toxic", "other"],
        )

    counted = (
        sample.select(utf8("text").alias("data"), "toxic")
        .mapInArrow(step, "word binary, toxic bigint, other bigint")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    total = counted.where("word IS NULL").first()
    if not total or not total["toxic"] or not total["other"]:
        return frozenset()
    share = F.col("toxic") / F.lit(float(total["toxic"]))
    # One count more in the other class: a word has to be missing from many documents to count.
    other = (F.col("other") + 1) / F.lit(float(total["other"] + 1))
    top = (
        counted.where(F.col("word").isNotNull() & (F.col("toxic") >= support) & (share / other >= odds))
        .orderBy((share / other).desc(), "word")
        .limit(words)
    )
    return frozenset(bytes(r["word"]) for r in top.select("word").collect())


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]
    listed: frozenset[bytes]

    def apply(self, docs: DataFrame) -> DataFrame:
        """The documents with their statistics and ``verdict`` (true: keep)."""
        return add_statistics(docs, self.listed).withColumn("verdict", keep_expression(list(self.rules)))


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DecisionList:
    """Fit lexicon and list on the bounded labelled sample."""
    ready(docs.sparkSession)
    sample = labelled_sample(docs, labels, rows)
    listed = learn_lexicon(sample)
    names = list(RATIOS)
    fitted = add_statistics(sample.select("doc_id", "text", "bad"), listed)
    pulled = fitted.select("doc_id", "bad", *[ratio(n).alias(n) for n in names]).toPandas()
    pulled = pulled.sort_values(["doc_id", "bad", *names], kind="stable")
    matrix = pulled[names].to_numpy(dtype=float).reshape(-1, len(names))
    rules = learn_list(matrix, pulled["bad"].to_numpy(dtype=bool), names, ids=pulled["doc_id"].to_numpy(dtype=np.int64))
    return DecisionList(tuple(rules), listed)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        model.apply(docs)
        .withColumn("base_failed", failed)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~failed & F.col("verdict")).alias("kept"),
            F.col("verdict").alias("list_keeps"),
        )
    )
