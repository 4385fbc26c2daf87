"""Language identification by sparse multinomial logistic regression on character n-grams.

A text is lower-cased; every run of characters that are no letters becomes one boundary, and so do its ends. Runs of
1 to ``LONGEST`` symbols (letters and boundaries) are hashed into ``SIZE`` features with the weight (1 + ln tf) * idf,
scaled to length 1. Document frequencies are counted over all training texts. The regression is trained by follow the
regularised leader, one adaptive rate for each weight, with an elastic net (``L1``, ``L2``): weights whose evidence stays
under the L1 bound are exactly 0. A temperature, fitted on rows held back from the training, then calibrates the
probabilities.

Fitting uses a bounded sample of labelled rows: about ``FIT_ROWS`` in the order of a hash of the id, dealt evenly over
the languages, each as the whole text and as an excerpt of ``EXCERPT`` words so that short texts are met in
training too; of a fitting row the ``FIT_TERMS`` heaviest features count. Prediction reads whole texts.
The model has one weight for each language and feature, so it is as large as the languages are many.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text where nothing could be
learned; with one language learned its probability is 1; equal probabilities go to the first language in order; rows without
an id are not held out and not learned from; repeated rows count, and are returned, each; no documents gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import ready, run_starts, table
from marketloom.operators.reports import top_k_per_key

UNKNOWN = "und"
LONGEST = 4
SIZE = 1 << 16
FIT_ROWS = 4000
FIT_TERMS = 4096
EXCERPT = 12
#: One row in so many of the sample calibrates and isn't learned from.
HELD_BACK = 5
EPOCHS = 3
#: Rate, its offset and the penalties of the follow-the-regularised-leader updates.
ALPHA = 0.5
BETA = 1.0
L1 = 0.02
L2 = 0.001
#: Characters of a text that are hashed at once.
CHUNK = 1 << 20
_BOUNDARY = 32
#: Multipliers of the rolling hash and of its last step; any odd numbers with mixed bits will do.
_STEP = np.uint64(0x9E3779B97F4A7C55)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


# ------------------------------------------------------------------ features


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def term_counts(text: str, size: int = SIZE) -> tuple[np.ndarray, np.ndarray] | None:
    """The features of a text in order and how often each occurs; None where it has no letter."""
    letters = _letters()
    tail = np.array([_BOUNDARY], dtype=np.uint32)
    found = False
    dense = np.zeros(size, dtype=np.int64) if len(text) > CHUNK else None
    kept: list[np.ndarray] = []
    for start in range(0, len(text) + CHUNK, CHUNK):
        # The last round is the closing boundary.
        points = np.frombuffer(text[start : start + CHUNK].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = letters[points]
        found = found or bool(letter.any())
        new = np.where(letter, points, np.uint32(_BOUNDARY)) if len(points) else tail[:0]
        if start + CHUNK >= len(text):
            new = np.append(new, np.uint32(_BOUNDARY))
        features, tail = _features(tail, new, size)
        if dense is None:
            kept.append(features)
        else:
            dense += np.bincount(features, minlength=size)
        if start + CHUNK >= len(text):
            break
    if not found:
        return None
    if dense is not None:
        at = np.flatnonzero(dense)
        return at, dense[at]
    ordered = np.sort(kept[0], kind="stable")
    at = np.flatnonzero(run_starts(ordered))
    return ordered[at].astype(np.int64), np.diff(np.append(at, len(ordered)))


def _features(tail: np.ndarray, new: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of the n-grams that end in the new symbols, and the symbols the next ones may begin in."""
    before = np.concatenate([tail[-1:], new[:-1]])
    new = new[(new != _BOUNDARY) | (before != _BOUNDARY)]
    line = np.concatenate([tail, new]).astype(np.uint64)
    shift = np.uint64(65 - size.bit_length())
    rolling = np.zeros(len(line), dtype=np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for n in range(1, min(LONGEST, len(line)) + 1):
            # rolling[i] is the hash of the n symbols from i.
            rolling = rolling[: len(line) - n + 1] * _STEP + line[n - 1 :] + np.uint64(n)
            out.append(((rolling[max(0, len(tail) - n + 1) :] * _SPREAD) >> shift).astype(np.uint16 if size <= 1 << 16 else np.int64))
    return np.concatenate(out), line[-(LONGEST - 1) :].astype(np.uint32)


def weighed(terms: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text and their weights, of length 1 together."""
    at, counts = terms
    weights = (1.0 + np.log(counts)) * idf[at]
    return at, weights / math.sqrt(float(weights @ weights))


def _excerpt(text: str, place: int) -> str:
    """``EXCERPT`` words from a place given by a number."""
    words = text.split()
    start = place % max(1, len(words) - EXCERPT + 1)
    return " ".join(words[start : start + EXCERPT])


# ------------------------------------------------------------------ learning


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


class Leader:
    """Multinomial regression by follow the regularised leader. The last feature is the intercept."""

    def __init__(self, classes: int, size: int) -> None:
        self.sums = np.zeros((size + 1, classes))
        self.squares = np.zeros((size + 1, classes))

    @staticmethod
    def weights(sums: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """The closed form of the leader: 0 under the L1 bound, shrunk beyond it."""
        beyond = np.sign(sums) * np.maximum(np.abs(sums) - L1, 0.0)
        return -beyond / ((BETA + roots) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        sums, squares = self.sums[at], self.squares[at]
        roots = np.sqrt(squares)
        weights = self.weights(sums, roots)
        error = _softmax(values @ weights)
        error[label] -= 1.0
        slope = values[:, None] * error
        squares += slope * slope
        self.sums[at] = sums + slope - (np.sqrt(squares) - roots) / ALPHA * weights
        self.squares[at] = squares

    def all_weights(self) -> np.ndarray:
        return self.weights(self.sums, np.sqrt(self.squares))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        scaled = logits / math.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(scaled - top).sum(axis=1))
        return float(np.mean(norm - scaled[np.arange(len(labels)), labels]))

    low, high, ratio = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, right) if loss(left) <= loss(right) else (left, high)
    return math.exp((low + high) / 2)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        terms = term_counts(text, len(self.idf)) if text and self.languages else None
        if terms is None:
            return UNKNOWN, 0.0
        at, values = weighed(terms, self.idf)
        logits = values @ self.weights[at] + self.weights[-1]
        chances = _softmax(logits / self.temperature)
        best = int(np.argmax(chances))
        return self.languages[best], float(chances[best])


def fitted(examples: list[tuple[np.ndarray, np.ndarray, int, bool]], languages: tuple[str, ...], idf: np.ndarray) -> Model:
    """Train on the examples that aren't held back, calibrate on those that are."""
    leader = Leader(len(languages), len(idf))
    train = [(np.append(at, len(idf)), np.append(x, 1.0), label) for at, x, label, held in examples if not held]
    for _ in range(EPOCHS):
        for at, values, label in train:
            leader.learn(at, values, label)
    weights = leader.all_weights()
    back = [(x @ weights[at] + weights[-1], label) for at, x, label, held in examples if held]
    logits = np.array([row for row, _ in back]).reshape(-1, len(languages))
    labels = np.array([label for _, label in back], dtype=np.int64)
    return Model(languages, idf, weights.astype(np.float32), temperature(logits, labels))


# ------------------------------------------------------------------ on Spark


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def document_frequencies(texts: DataFrame, size: int = SIZE) -> tuple[np.ndarray, int]:
    """In how many of the texts each feature occurs, and how many texts have a letter. One column: the text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms = term_counts(text, size)
                if terms is not None:
                    seen[terms[0]] += 1
                    texts += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[at], texts))], names=["feature", "texts"]
        )

    counted = texts.mapInArrow(step, "feature bigint, texts bigint").groupBy("feature").agg(F.sum("texts").alias("texts"))
    # One row for each feature at most.
    found = counted.toArrow()
    out = np.zeros(size + 1, dtype=np.int64)
    out[found.column("feature").to_numpy()] = found.column("texts").to_numpy()
    return out[:size], int(out[size])


def _examples(sample: DataFrame, idf: np.ndarray) -> DataFrame:
    """Two rows of features for each sampled row: the whole text and the excerpt."""
    kinds = "lang string, place bigint, id bigint, part int, features binary, weights binary"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for lang, place, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part, piece in enumerate((text, _excerpt(text, place))):
                    terms = term_counts(piece, len(idf))
                    if terms is None:
                        continue
                    at, x = weighed(terms, idf)
                    if len(at) > FIT_TERMS:
                        heavy = np.sort(np.argsort(-x, kind="stable")[:FIT_TERMS])
                        at, x = at[heavy], x[heavy]
                    row = (lang, place, doc, part, at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes())
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                names=["lang", "place", "id", "part", "features", "weights"],
            )

    return sample.mapInArrow(step, kinds)


def learn(docs: DataFrame, rows: int = FIT_ROWS, size: int = SIZE) -> Model:
    """A model from doc_id, text and lang of the documents that aren't held out."""
    ready(docs.sparkSession)
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = known.select(F.col("doc_id").cast("bigint").alias("id"), "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["rows"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()}
    seen, texts = document_frequencies(known.select("text"), size)
    idf = np.log((1.0 + texts) / (1.0 + seen)) + 1.0
    if not sizes or not texts:
        return Model((), idf, np.zeros((size + 1, 0), dtype=np.float32), 1.0)

    # A hash cuts every language to somewhat more than its share; the cut to the share then moves few rows.
    each = math.ceil(rows / len(sizes))
    place = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 31))
    cuts = {lang: min(1.0, (1.2 * each + 20) / n) * (1 << 31) for lang, n in sizes.items()}
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])[F.col("lang")]
    drawn = known.withColumn("place", place).where(F.col("place") < cut).select("lang", "place", "id", "text")
    order = [F.col("place"), F.col("id"), F.xxhash64("features"), F.xxhash64("weights")]
    chosen = top_k_per_key(_examples(drawn, idf), ["lang", "part"], order, each, "rank").drop("rank")
    pulled = chosen.toArrow().to_pylist()
    pulled.sort(key=lambda r: (r["place"], r["id"], r["part"], r["lang"], r["features"], r["weights"]))
    languages = tuple(sorted({r["lang"] for r in pulled}))
    label = {lang: i for i, lang in enumerate(languages)}
    held: dict[str, int] = {}
    examples = []
    for r in pulled:
        held[r["lang"]] = held.get(r["lang"], 0) + (r["part"] == 0)
        at = np.frombuffer(r["features"], dtype=np.int32)
        x = np.frombuffer(r["weights"], dtype=np.float32).astype(float)
        examples.append((at, x, label[r["lang"]], held[r["lang"]] % HELD_BACK == 0))
    return fitted(examples, languages, idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(step, "doc_id bigint, held_out boolean, lang_pred string, score double")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs))
