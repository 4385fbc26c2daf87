"""Language-model scores by the marginal likelihood of a subword lattice.

A text is the words of ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end. Every word, with the
vocabulary's word mark before it, is a lattice of all ways to cut it into vocabulary pieces; single bytes
are pieces too, so every word has a segmentation. The probability of a word is the sum over all its
segmentations of the product of the piece probabilities, by the forward recursion in log space; a text's
is the product over its words times the probability of the end.

The vocabulary and its scores are existing ones (a public tokenizer's file). Its scores are merge ranks, so the
first weights are a Zipf law of the rank; ``STEPS`` expectation-maximisation steps over the counts of all distinct
training words turn them into piece probabilities of the training corpus.

Words are counted over the whole corpus. Lattices are evaluated once for each distinct word, in tasks over
the table of words. Texts meet the words' scores by a join, except for the words that make up at least
one ``HOT_PARTS``-th of the corpus: there can be ``HOT_PARTS`` of those at most, and they go to every task.

Defined cases: null or empty text is the end alone; without training documents counts are 0 and the
first weights stay; words of any length are scored whole; a row repeated with the same id counts and is
returned once for each repetition (the fold depends on the id alone).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import gathered, staged, table, utf8, words_of

HOT_PARTS = 1 << 18
#: Longer words are never sent to every task.
HOT_BYTES = 64
#: Counts a task holds before it passes them on.
HELD_COUNTS = 300_000
#: Words whose lattices are evaluated together.
WORDS_AT_ONCE = 1 << 15
#: Expectation-maximisation steps over the training words.
STEPS = 2
#: Pseudo-count of the first weights in the re-estimation, in pieces for the whole vocabulary.
PRIOR = 1000.0


# ------------------------------------------------------------------ the vocabulary


@dataclass(frozen=True)
class Pieces:
    """Pieces as bytes (the word mark is a space) with natural-log probabilities; the last one is the end."""

    names: tuple[bytes, ...]
    log_p: np.ndarray

    def lattice(self) -> Lattice:
        return Lattice(self)


def read_vocabulary(path: str) -> Pieces:
    """Pieces of a vocabulary file, the 256 single bytes among them, weighted by a Zipf law of the score's rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scored: dict[bytes, float] = {bytes([b]): math.inf for b in range(256)}
    for i in range(model.vocab_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("\N{LOWER ONE EIGHTH BLOCK}", " ").encode()
        if b" " not in piece[1:]:
            scored[piece] = min(scored.get(piece, math.inf), -model.get_score(i))
    names = sorted(scored)
    ranks = np.argsort(np.argsort([scored[n] for n in names], kind="stable"), kind="stable")
    weights = 1.0 / (ranks + 3.0)
    # An end after a hundred pieces, until the corpus tells.
    weights = np.append(weights / weights.sum() * 0.99, 0.01)
    return Pieces((*names, b""), np.log(weights))


class Lattice:
    """Forward and backward sums for words of one length at a time, in log space."""

    def __init__(self, pieces: Pieces) -> None:
        self.longest = max(map(len, pieces.names))
        self.size = len(pieces.names)
        # For each length: the pieces of that length, packed as integers where they fit, and their numbers.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(n) for n in pieces.names])
        for n in range(1, self.longest + 1):
            at = np.flatnonzero(lengths == n)
            if len(at):
                keys = _keys(np.frombuffer(b"".join(pieces.names[i] for i in at), dtype=np.uint8).reshape(-1, n))
                order = np.argsort(keys, kind="stable")
                self.by_length[n] = keys[order], at[order]
        self.log_p = pieces.log_p

    def _edges(self, block: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """For (start, length): the rows that have a piece there, and the piece."""
        edges = {}
        for n, (keys, numbers) in self.by_length.items():
            for start in range(block.shape[1] - n + 1):
                wanted = _keys(block[:, start : start + n])
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                rows = np.flatnonzero(keys[at] == wanted)
                if len(rows):
                    edges[start, n] = rows, numbers[at[rows]]
        return edges

    def _forward(self, block: np.ndarray, edges: dict) -> np.ndarray:
        alpha = np.full((block.shape[1] + 1, len(block)), -np.inf)
        alpha[0] = 0.0
        for start in range(block.shape[1]):
            for n in range(1, min(self.longest, block.shape[1] - start) + 1):
                if (start, n) in edges:
                    rows, numbers = edges[start, n]
                    alpha[start + n, rows] = np.logaddexp(alpha[start + n, rows], alpha[start, rows] + self.log_p[numbers])
        return alpha

    def marginal(self, block: np.ndarray) -> np.ndarray:
        """Natural-log probability of each word (rows of bytes of equal length), over all segmentations."""
        return self._forward(block, self._edges(block))[-1]

    def expected(self, block: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Add the expected number of uses of each piece, each word weighted by its count."""
        edges = self._edges(block)
        alpha = self._forward(block, edges)
        width = block.shape[1]
        beta = np.full_like(alpha, -np.inf)
        beta[width] = 0.0
        for start in range(width - 1, -1, -1):
            for n in range(1, min(self.longest, width - start) + 1):
                if (start, n) in edges:
                    rows, numbers = edges[start, n]
                    beta[start, rows] = np.logaddexp(beta[start, rows], beta[start + n, rows] + self.log_p[numbers])
        total = alpha[width]
        for (start, n), (rows, numbers) in edges.items():
            chance = np.exp(alpha[start, rows] + self.log_p[numbers] + beta[start + n, rows] - total[rows])
            into += np.bincount(numbers, weights=chance * counts[rows], minlength=self.size)


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as one sortable value each."""
    n = rows.shape[1]
    if n <= 8:
        padded = np.zeros((len(rows), 8), dtype=np.uint8)
        padded[:, 8 - n :] = rows
        return padded.view(">u8").reshape(-1).astype(np.uint64)
    return np.ascontiguousarray(rows).view(f"S{n}").reshape(-1)


def blocks_of(words: list[bytes], cells: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words with the mark, grouped by length: their positions and their bytes as a matrix of bounded size."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order])) + 1
    for at in np.split(order, edges) if len(words) else ():
        n = int(lengths[at[0]]) + 1
        step = max(1, cells // n)
        for i in range(0, len(at), step):
            some = at[i : i + step]
            yield some, np.frombuffer(b"".join(b" " + words[k] for k in some), dtype=np.uint8).reshape(-1, n)


# ------------------------------------------------------------------ the corpus


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2


def word_counts(docs: DataFrame, text: str = "text", fold: Column | None = None) -> DataFrame:
    """word, known (its count in training texts), total (in all), over all texts; the empty word counts ends."""
    fold = held_out() if fold is None else fold
    source = docs.select(utf8(text).alias("data"), F.coalesce(fold, F.lit(False)).alias("out"))

    def flush(known: Counter, out: Counter) -> pa.RecordBatch:
        words = list(known | out)
        trained = [known[w] for w in words]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array(trained, pa.int64()),
             pa.array([t + out[w] for t, w in zip(trained, words, strict=True)], pa.int64())],
            names=["word", "known", "total"],
        )
        known.clear()
        out.clear()
        return batch

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = Counter(), Counter()
        for batch in batches:
            texts, fold = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for counter, part in ((known, [not f for f in fold]), (out, fold)):
                mine = list(compress(texts, part))
                counter.update(words_of(b"\n".join(mine).lower()))
                counter[b""] += len(mine)
            if len(known) + len(out) > HELD_COUNTS:
                yield flush(known, out)
        yield flush(known, out)

    partial = source.mapInArrow(step, "word binary, known bigint, total bigint")
    return partial.groupBy("word").agg(F.sum("known").alias("known"), F.sum("total").alias("total"))


def reestimate(counts: DataFrame, pieces: Pieces, prior: float = PRIOR) -> Pieces:
    """One expectation-maximisation step over the distinct training words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, into = pieces.lattice(), np.zeros(len(pieces.names))
        for batch in gathered(batches, WORDS_AT_ONCE):
            words = batch.column(0).to_pylist()
            known = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for at, block in blocks_of(words):
                lattice.expected(block, known[at], into)
        used = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(into[used], pa.float64())], names=["piece", "uses"]
        )

    trained = counts.where("known > 0 AND word <> X''").select("word", "known")
    # The vocabulary bounds the rows that come back.
    found = trained.mapInArrow(step, "piece bigint, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    rows = found.orderBy("piece").collect()
    ends = counts.where("word = X''").agg(F.sum("known").alias("n")).first()["n"] or 0
    uses = prior * np.exp(pieces.log_p)
    for r in rows:
        # Sums of floats differ in their last bits from run to run; the model doesn't need them.
        uses[r["piece"]] += float(f"{r['uses']:.9g}")
    uses[-1] += ends
    return Pieces(pieces.names, np.log(uses / uses.sum()))


def scored_words(counts: DataFrame, pieces: Pieces, train_tokens: int, distinct: int) -> DataFrame:
    """word, known, total, base and score (log10), a row for each distinct word and the empty one for the end."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = pieces.lattice()
        for batch in gathered(batches, WORDS_AT_ONCE):
            words = batch.column(0).to_pylist()
            score = np.full(len(words), pieces.log_p[-1])
            for at, block in blocks_of(words):
                if block.shape[1] > 1:
                    score[at] = lattice.marginal(block)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score / math.log(10), pa.float64())], names=[*batch.schema.names, "score"]
            )

    base = F.log10((F.col("known") + 1) / F.lit(float(train_tokens + distinct + 1)))
    return (
        counts.select("word", "known", "total")
        .mapInArrow(step, "word binary, known bigint, total bigint, score double")
        .withColumn("base", base)
    )


def score_texts(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    fold: Column | None = None,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each text."""
    fold = held_out(doc_id) if fold is None else fold
    counts = staged(word_counts(docs, text, fold), "word_counts")
    sums = counts.agg(
        F.sum("known").alias("tokens"),
        F.count(F.when(F.col("known") > 0, 1)).alias("distinct"),
        F.sum("total").alias("all"),
    ).first()
    tokens, distinct, total = sums["tokens"] or 0, sums["distinct"] or 0, sums["all"] or 0
    pieces = read_vocabulary(vocabulary_path or default_vocabulary())
    for _ in range(STEPS):
        pieces = reestimate(counts, pieces)
    scored = staged(scored_words(counts, pieces, tokens, distinct), "scored_words")

    # Words with at least 1 in HOT_PARTS of all tokens: HOT_PARTS rows at most.
    often = (F.col("total") * HOT_PARTS >= total) & (F.length("word") <= HOT_BYTES) | (F.col("word") == F.lit(b""))
    hot = scored.where(often).select("word", "known", "base", "score").toPandas()
    at = {bytes(w): i for i, w in enumerate(hot["word"])}
    values = (at, (hot["known"] > 0).to_numpy(), hot["base"].to_numpy(dtype=float), hot["score"].to_numpy(dtype=float))
    shared = docs.sparkSession.sparkContext.broadcast(values)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(fold, F.lit(False)).alias("held_out"),
        utf8(text).alias("data"),
        F.monotonically_increasing_id().alias("row"),
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, base, score = shared.value
        for batch in batches:
            ids, out, row = (batch.column(i).to_pylist() for i in (0, 1, 3))
            columns: list[list] = [[] for _ in range(8)]
            for doc, fold, data, number in zip(ids, out, batch.column(2).to_pylist(), row, strict=True):
                words = words_of(data.lower())
                words.append(b"")
                found = np.fromiter(map(at.get, words, repeat(-1)), dtype=np.int64, count=len(words))
                rest = found < 0
                found = found[~rest]
                # One row for the hot words; its key is no word, so it joins with none.
                entry = [(b" %d" % number, len(words), int(known[found].sum()), float(base[found].sum()), float(score[found].sum()))]
                entry += [(w, n, 0, 0.0, 0.0) for w, n in Counter(compress(words, rest)).items()]
                for k, column in enumerate(zip(*entry, strict=True)):
                    columns[k + 3].extend(column)
                columns[0].extend(repeat(doc, len(entry)))
                columns[1].extend(repeat(fold, len(entry)))
                columns[2].extend(repeat(number, len(entry)))
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            names = ["doc_id", "held_out", "row", "word", "n", "n_known", "base", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id bigint, held_out boolean, row bigint, word binary, n bigint, n_known bigint, base double, score double"
    used = rows.mapInArrow(step, schema)
    rare = scored.where(~often).select(
        F.col("word").alias("_word"), F.col("known").alias("_known"), F.col("base").alias("_base"), F.col("score").alias("_score")
    )
    own = F.col("_word").isNull()
    return (
        used.join(rare, F.col("word") == F.col("_word"), "left")
        .groupBy("doc_id", "held_out", "row")
        .agg(
            F.sum(F.when(own, F.col("n")).otherwise(0)).alias("n_tokens"),
            F.sum(F.when(own, F.col("n_known")).when(F.col("_known") > 0, F.col("n")).otherwise(0)).alias("n_known"),
            F.sum(F.when(own, F.col("base")).otherwise(F.col("n") * F.col("_base"))).alias("base_score"),
            F.sum(F.when(own, F.col("score")).otherwise(F.col("n") * F.col("_score"))).alias("score"),
        )
        .withColumn("train_tokens", F.lit(tokens).cast("bigint"))
        .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    )


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
