"""Phrase collocations by Toivonen's sampling method.

Texts have A-Z in lower case and are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into words;
a phrase is a run of words inside a piece. Everything is kept apart by language (null: ``und``).

* **Sample.** One document in ``SAMPLE`` by a hash of its id is mined level by level, with a threshold lowered by one
  standard deviation. The phrases found frequent there are the proposals.
* **Full pass.** Every single word is counted, and every longer phrase whose first words and whose last words (all but one)
  are both proposed: these are the proposals and their negative border, as far as it occurs. Proposals, and phrases of the
  greatest length, are counted by their words. The border is far larger and hardly ever frequent, so it is counted by 64-bit
  hashes; two phrases that share one can only make a count too high.
* **Expansion.** Phrases that prove frequent without having been proposed are failures of the border. A frequent phrase that
  wasn't counted has an end that wasn't proposed; that end is frequent too, so it is such a failure or wasn't counted
  either, and so on down: it holds a failure. A further pass counts the failures by their words, and with them what holds a
  failure and wasn't counted, of all lengths at once. Nothing frequent is then left uncounted, and every count is exact.

Tasks know proposals and failures from Bloom filters of bounded size. They never miss one; what they let pass besides, or when
they are full, is counted for nothing and leaves the result as it is. What the full pass counted is told by the same
filter again, so no phrase is counted twice. Counts are combined in the task before the shuffle, in sections of
``SECTION`` words.

A candidate is a frequent phrase of 2 to ``LONGEST`` words with a occurrences. Cut after its first k words it scores
``floor(1000 a n / (l r))`` by the counts of its parts; the cut with the lowest score counts, then the smallest k. Products are
38-digit decimals. A candidate inside a longer one with as many occurrences (``KEPT_PERCENT``) is dropped. Both parts
and the longer phrase are joined by phrase; no phrase has more than LONGEST - 1 cuts and two phrases one word shorter.

Defined cases: null and empty texts have no words; a very long text is divided into words in steps and counted in
sections that overlap by the words of a phrase; repeated rows count each; rows without an id are sampled by their text;
equal ranks don't occur, as phrases of a language differ; no documents gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bloom import Filter, blocks_for, filter_rows
from marketloom.llm.common import mix64, ready, run_starts, staged, table, utf8
from marketloom.operators.reports import top_k_per_key

LONGEST = 5
LEAST = 100
BEST = 2000
#: One document in so many is sampled.
SAMPLE = 8
KEPT_PERCENT = 100
#: Words that are counted together before they are passed on.
SECTION = 1 << 22
#: Bytes of a text that are divided into words at once.
CHUNK = 1 << 20

_TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
_ENDS = frozenset(b".,;:!?\n\x0b\x0c\r")
_BLANKS = frozenset(b" \t") | _ENDS
_END = 0


# ------------------------------------------------------------------ words


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in steps that end before a blank or the end of a piece."""
    start = 0
    while start < len(data):
        end = min(len(data), start + CHUNK)
        while end < len(data) and data[end] not in _BLANKS:
            end += 1
        yield data[start:end]
        start = end


class Words:
    """Numbers of the words of one language in a task, the words met so far, and a hash of each."""

    def __init__(self, lang: str) -> None:
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        for end in _ENDS:
            self.numbers[bytes([end])] = _END
        # The numbers go on behind the ends of pieces, which share the first one.
        self.lang = lang
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=7)
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, data: bytes) -> None:
        number = self.numbers
        for part in _parts(data.lower()):
            tokens = _TOKEN.findall(part)
            self.texts.append(np.fromiter(map(number.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
            self.size += len(tokens)
        self.texts.append(np.zeros(1, dtype=np.int32))
        self.size += 1

    def line(self) -> np.ndarray:
        return np.concatenate(self.texts)

    def names(self) -> tuple[list[bytes], np.ndarray]:
        """The words by number, and their hashes with the language."""
        names = [b""] * len(self.numbers)
        for word, i in self.numbers.items():
            names[i] = word
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed=self.seed) for w in names), dtype=np.uint64, count=len(names))
        return names, hashes


def longer(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its first words and that of its last one."""
    with np.errstate(over="ignore"):
        return mix64(head * np.uint64(0x9E3779B97F4A7C15) + tail)


# ------------------------------------------------------------------ counting


class Pass:
    """What a pass counts of the given lengths: without ``missed``, single words and phrases whose two ends were proposed; with
    it, the missed ones and what holds one. ``spell_all`` gives all of it with its words, else the border goes by hash."""

    def __init__(self, lengths: tuple[int, ...], proposed: Filter | None, missed: Filter | None, spell_all: bool) -> None:
        self.lengths, self.proposed, self.missed, self.spell_all = lengths, proposed, missed, spell_all

    def rows(self, words: Words) -> Iterator[pa.RecordBatch]:
        if not words.size:
            return
        names, word_hash = words.names()
        named = pa.array(names, pa.binary())
        line = words.line()
        yield _rows(pa.array([words.lang]), pa.nulls(1, pa.string()), 0, np.zeros(1, np.uint64), np.array([np.count_nonzero(line)]))
        for start in range(0, len(line), SECTION):
            section = line[start : start + SECTION + LONGEST - 1]
            for n, at, counts, hashes, spelled in self._section(section, word_hash):
                own = at[spelled]
                columns = [pc.take(named, pa.array(section[own + i])) for i in range(n)]
                phrase = columns[0] if n == 1 else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))
                lang = pa.array([words.lang] * len(own), pa.string())
                yield _rows(lang, phrase.cast(pa.string()), n, hashes[spelled], counts[spelled])
                rest = len(at) - len(own)
                yield _rows(pa.nulls(rest, pa.string()), pa.nulls(rest, pa.string()), n, hashes[~spelled], counts[~spelled])

    def _section(self, line: np.ndarray, word_hash: np.ndarray) -> Iterator[tuple]:
        """(words, first places, counts, hashes, whether it is spelled) of the distinct phrases that begin in the section."""
        own = min(SECTION, len(line))
        is_word = line != _END
        # Equal phrases have equal marks; those of n + 1 words come from those of n words and the next word.
        inside, hashes, marks = is_word, word_hash[line], line.astype(np.int64)
        over, ends = np.zeros(len(line), dtype=bool), inside
        new: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, min(max(self.lengths), len(line)) + 1):
            if n > 1:
                inside = inside[:-1] & is_word[n - 1 :]
                ends = inside & proposed[:-1] & proposed[1:]
                over = inside & (holds[:-1] | holds[1:])
                hashes = longer(hashes[:-1], word_hash[line[n - 1 :]])
                at = np.flatnonzero(ends)
                grown = np.zeros(len(hashes), dtype=np.int64)
                grown[at] = _ranks(marks[at] * len(word_hash) + line[at + n - 1])
                marks = grown
            proposed = _members(self.proposed, hashes, marks, ends)
            failed = _members(self.missed, hashes, marks, ends)
            holds = over | failed
            if n not in self.lengths:
                continue
            if self.missed is not None:
                again = failed & ~proposed if n < LONGEST else np.zeros(len(ends), dtype=bool)
                new[n] = (((over & ~ends) | again)[:own], hashes)
            else:
                first, counts = self._distinct(np.flatnonzero(ends[:own]), marks)
                spelled = np.ones(len(first), dtype=bool) if self.spell_all or n == LONGEST else proposed[first]
                yield n, first, counts, hashes[first], spelled
        if new:
            yield from self._expanded(line, new, len(word_hash))

    def _expanded(self, line: np.ndarray, new: dict[int, tuple[np.ndarray, np.ndarray]], numbers: int) -> Iterator[tuple]:
        """The distinct phrases at the places that are new at some length; these get marks of their own at every length."""
        any_length = np.zeros(len(line), dtype=bool)
        for fresh, _ in new.values():
            any_length[: len(fresh)] |= fresh
        at = np.flatnonzero(any_length)
        marks = line[at].astype(np.int64)
        whole = np.zeros(len(line), dtype=np.int64)
        for n in range(1, max(new) + 1):
            if n > 1:
                marks = _ranks(marks * numbers + line[np.minimum(at + n - 1, len(line) - 1)])
            if n in new:
                fresh, hashes = new[n]
                mine = at < len(fresh)
                mine[mine] = fresh[at[mine]]
                whole[at] = marks
                first, counts = self._distinct(at[mine], whole)
                yield n, first, counts, hashes[first], np.ones(len(first), dtype=bool)

    @staticmethod
    def _distinct(at: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each mark among the given places, and how many have it."""
        order = np.argsort(marks[at], kind="stable")
        starts = np.flatnonzero(run_starts(marks[at][order])) if len(at) else order
        return at[order[starts]], np.diff(np.append(starts, len(at)))


def _rows(lang: pa.Array, phrase: pa.Array, words: int, hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    number = pa.array(np.full(len(hashes), words, dtype=np.int32))
    columns = [lang, phrase, number, pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "key", "f"])


def _ranks(values: np.ndarray) -> np.ndarray:
    """Numbers from 1 that are equal where the values are."""
    order = np.argsort(values, kind="stable")
    out = np.empty(len(values), dtype=np.int64)
    out[order] = np.cumsum(run_starts(values[order]))
    return out


def _members(f: Filter | None, hashes: np.ndarray, marks: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the phrases at the given places; each distinct one is looked up once."""
    out = np.zeros(len(hashes), dtype=bool)
    at = np.flatnonzero(where)
    if f is not None and len(at):
        slots = np.full(int(marks[at].max()) + 1, -1, dtype=np.int64)
        slots[marks[at]] = at
        known = np.flatnonzero(slots >= 0)
        hit = np.zeros(len(slots), dtype=bool)
        hit[known] = f.hits(hashes[slots[known]])
        out[at] = hit[marks[at]]
    return out


_COUNTED = "lang string, phrase string, words int, key bigint, f bigint"


def count_phrases(
    texts: DataFrame,
    lengths: tuple[int, ...],
    proposed: Filter | None = None,
    missed: Filter | None = None,
    spell_all: bool = True,
) -> DataFrame:
    """lang, phrase, words, key, f of what a pass counts. ``texts`` has lang and the text as bytes.

    Rows without a phrase are the border by hash; rows of 0 words are the number of words in each language.
    """
    plan = texts.sparkSession.sparkContext.broadcast(Pass(lengths, proposed, missed, spell_all))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Words] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in held:
                    held[lang] = Words(lang)
                held[lang].add(data)
            if sum(w.size for w in held.values()) >= SECTION:
                for words in held.values():
                    yield from plan.value.rows(words)
                held = {}
        for words in held.values():
            yield from plan.value.rows(words)

    # Sections have combined their counts, so rows go straight to the task of their key.
    partial = texts.mapInArrow(step, _COUNTED).repartition("key")
    return partial.groupBy("key", "lang", "phrase", "words").agg(F.sum("f").alias("f"))


def _frequent(counted: DataFrame, least: int) -> DataFrame:
    return counted.where((F.col("f") >= least) & (F.col("words") > 0))


def _filter(proposed: DataFrame) -> Filter:
    blocks = blocks_for(proposed.count())
    return Filter(filter_rows(proposed, "key", blocks), blocks)


def sampled_phrases(texts: DataFrame, least: int, longest: int = LONGEST) -> DataFrame:
    """Frequent phrases of the texts, mined level by level: the words, then what is over the frequent ones."""
    found = staged(_frequent(count_phrases(texts, (1,)), least), "sampled_words")
    for n in range(2, longest):
        # Phrases of the longest kind are over no others, so they need not be proposed.
        grown = _frequent(count_phrases(texts, (n,), _filter(found)), least)
        found = found.unionByName(staged(grown, f"sampled_{n}"))
    return found


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame, int]:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences, the words of each language (lang, n),
    and how many full passes it took. ``docs`` has doc_id, text and lang."""
    spark = ready(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), utf8("text").alias("data"), F.col("doc_id").cast("string").alias("id")
    )
    texts = rows.select("lang", "data")
    drawn = F.pmod(F.xxhash64(F.lit(5), F.coalesce("id", F.lit("")), F.when(F.col("id").isNull(), F.col("data"))), F.lit(sample)) == 0
    expected = least / sample
    lowered = max(1, math.floor(expected - math.sqrt(expected)))
    proposed = sampled_phrases(rows.where(drawn).select("lang", "data"), lowered, longest)

    lengths = tuple(range(1, longest + 1))
    held = _filter(proposed)
    full = count_phrases(texts, lengths, held, spell_all=False).where((F.col("f") >= least) | (F.col("words") == 0))
    counted = staged(full, "phrase_counts")
    sizes = counted.where((F.col("words") == 0) & (F.col("f") > 0)).select("lang", F.col("f").alias("n"))
    frequent = _frequent(counted, least)
    spelled = frequent.where(F.col("phrase").isNotNull())
    unknown = spelled.where(F.col("words") < longest).join(proposed.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    missed = frequent.where(F.col("phrase").isNull()).select("key").unionByName(unknown.select("key"))
    missed = staged(missed, "missed_phrases")
    if missed.isEmpty():
        return spelled, sizes, 1
    more = staged(_frequent(count_phrases(texts, lengths, held, _filter(missed)), least), "expanded_phrases")
    return spelled.unionByName(more), sizes, 2


# ------------------------------------------------------------------ scores


def collocations(frequent: DataFrame, sizes: DataFrame, percent: int = KEPT_PERCENT, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best candidates."""
    counts = frequent.select("lang", "phrase", "f")
    candidates = frequent.where("words >= 2").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    size = F.size("w")

    shorter = candidates.where(size > 2).select(
        "lang",
        F.explode(F.array(*[F.array_join(F.slice("w", at, size - 1), " ") for at in (1, 2)])).alias("phrase"),
        F.col("a").alias("over"),
    )
    cover = shorter.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    covered = F.coalesce(F.col("over") * 100 >= F.col("a") * percent, F.lit(False))
    kept = candidates.join(cover, ["lang", "phrase"], "left").where(~covered).drop("over")

    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    parts = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, size - F.col("k")), " ").alias("tail"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    a, n, left, right = (F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r"))
    scored = (
        parts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(sizes, "lang")
        .withColumn("_up", (a * n).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
        .withColumn("_down", left * right)
        .withColumn("score", F.expr("_up div _down"))
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    rows = lowest.select("lang", "phrase", *[F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = top_k_per_key(rows, ["lang"], order, best, "rank")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    frequent, sizes, _ = frequent_phrases(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return collocations(frequent, sizes)


#: The patterns and limits are fixed by the query's definition.
OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k
), counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, f AS a, k AS size, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 100
), inner_phrases AS (
  SELECT lang, a AS over, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, size - m + 2)]) AS phrase
  FROM candidates, (SELECT unnest([2, 3, 4]) AS m) WHERE m < size
), covers AS (SELECT lang, phrase, max(over) AS over FROM inner_phrases GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN covers v USING (lang, phrase)
  WHERE v.over IS NULL OR 100 * v.over < 100 * c.a
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
  FROM kept, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < size
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, s.n,
         CAST((1000::HUGEINT * c.a * s.n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head
       JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail JOIN sizes s ON s.lang = c.lang
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
