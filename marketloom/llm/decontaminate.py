"""Benchmark passages in documents by the q-gram lemma, diagonal bands and banded alignment.

Benchmark items are cut into overlapping windows of ``WINDOW`` bytes. A stretch of a document within ``EDITS``
edits of a window shares at least ``WINDOW - Q + 1 - EDITS * Q`` of its q-grams with it (the q-gram lemma), all in
diagonals (place in the document less place in the item) that differ by ``EDITS`` at most. Shared q-grams are
counted per window in overlapping bands of diagonals; bands that reach the bound are aligned with the
window, and the match stands if its edit distance is within the budget. Equal windows are one.

Text that repeats a few bytes over and over (rules, separators) would share a place with every place. A q-gram that a
window has several times is one entry with its first and last place and its number, which can only make a
count too high; and where a document has far more hits than places, stretches of one period are
shortened by whole periods before the search and the matches found there stretched again.

Texts are compared in lower case (A-Z) with white space runs as one space. Items go to every task in
shards of ``SHARD_BYTES`` at most, one pass over the documents each, so what is sent is bounded however
many items there are.

Items shorter than ``LEAST_ITEM`` bytes are looked for as they are, without edits, and only between bytes that are no
letters or digits. They match by chance, so ``clean_documents`` doesn't drop a document for one alone.

Defined cases: null or empty texts and items match nothing; longer items shorter than a window are one window with a budget in proportion; repeated items are
found each; repeated documents are returned each; no items or documents gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bloom import split_by_ids
from marketloom.llm.common import mix64, ready, run_starts, staged, table, utf8

Q = 10
WINDOW = 96
EDITS = 8
LEAST_ITEM = 40
SHARD_BYTES = 4 << 20
#: Places of a document whose hits are held at once.
SEGMENT = 1 << 16
#: Periods of stretches that can be shortened, and what stays at both of their ends.
PERIODS = range(1, 17)
EDGE = 2 * WINDOW
#: Hits for each place of a document from which on stretches are looked for.
CROWDED = 4

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def normal(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with white space runs as one space, and where each comes from."""
    raw = np.frombuffer(data.lower(), dtype=np.uint8)
    space = _SPACE[raw]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    at = np.flatnonzero(keep)
    return np.where(space[at], np.uint8(32), raw[at]), at


def qgrams(text: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` bytes from each place."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for k in range(Q):
            out = out * np.uint64(0x9E3779B97F4A7C15) + text[k : n + k].astype(np.uint64) + np.uint64(1)
        return mix64(out)


def budget(length: int) -> int:
    """Edits allowed in a window, so that at least one q-gram has to be shared."""
    return max(0, min(length * EDITS // WINDOW, (length - Q) // Q))


@dataclass
class Shortened:
    """A text without the middles of its stretches of one period, and the way back to its places."""

    text: np.ndarray
    cuts: np.ndarray  # places in the short text where bytes were taken out
    taken: np.ndarray  # bytes taken out up to and with each cut

    def back(self, start: int, end: int) -> tuple[int, int]:
        """A stretch in the whole text; one around a cut covers what was taken out there."""
        before, upto = np.searchsorted(self.cuts, [start, end - 1], side="right").tolist()
        return start + (int(self.taken[before - 1]) if before else 0), end + (int(self.taken[upto - 1]) if upto else 0)


def shortened(text: np.ndarray) -> Shortened:
    """Stretches of one period keep ``EDGE`` bytes at both ends; whole periods go from between.

    What matches a window inside such a stretch matches it a period further on too, so the places taken out
    hold only matches that those around the cut stand for.
    """
    n = len(text)
    gone = np.zeros(n, dtype=bool)
    for p in PERIODS:
        if n <= 2 * EDGE + 2 * p:
            break
        same = np.concatenate([[False], text[p:] == text[:-p], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            # Bytes a to b + p repeat with period p.
            drop = (b + p - a - 2 * EDGE) // p * p
            if drop > 0 and not gone[a : b + p].any():
                gone[a + EDGE : a + EDGE + drop] = True
    kept = np.flatnonzero(~gone)
    cuts = np.flatnonzero(np.diff(kept, prepend=-1) > 1)
    return Shortened(text[kept], cuts, kept[cuts] - cuts)


@dataclass
class Index:
    """The q-grams of the windows of some items."""

    items: list[tuple[int, np.ndarray]]
    contents: list[np.ndarray]  # the windows' bytes
    owners: list[list[tuple[int, int]]]  # item number and start of each place of a window
    shape: np.ndarray  # length and budget of each window
    keys: np.ndarray  # sorted q-grams, one entry for each window that has it
    window: np.ndarray  # window of each entry
    first: np.ndarray  # first and last place of the q-gram in the window, and its number of places
    last: np.ndarray
    times: np.ndarray
    bits: np.ndarray  # 2^20 flags of the keys' low bits, to pass most places over
    short: list[tuple[int, bytes]]  # items looked for as they are

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Index:
        texts = [(i, normal(data)[0]) for i, data in rows]
        items = [(i, text) for i, text in texts if len(text) >= LEAST_ITEM]
        short = [(i, text.tobytes().strip()) for i, text in texts if len(text) < LEAST_ITEM]
        number: dict[bytes, int] = {}
        contents, owners, shape = [], [], []
        parts: list[tuple[np.ndarray, ...]] = [tuple(np.zeros(0, dtype=np.int64) for _ in range(5))]
        for item, (_, text) in enumerate(items):
            length = min(WINDOW, len(text))
            starts = list(range(0, len(text) - length + 1, WINDOW // 2))
            if starts[-1] != len(text) - length:
                starts.append(len(text) - length)
            for start in starts:
                content = text[start : start + length]
                window = number.setdefault(content.tobytes(), len(contents))
                if window < len(contents):
                    owners[window].append((item, start))
                    continue
                contents.append(content)
                owners.append([(item, start)])
                shape.append((length, budget(length)))
                grams = qgrams(content)
                order = np.argsort(grams, kind="stable")
                edges = np.flatnonzero(run_starts(grams[order]))
                ends = np.concatenate([edges[1:], [len(order)]])
                parts.append((grams[order][edges].view(np.int64), np.full(len(edges), window), order[edges], order[ends - 1], ends - edges))
        keys, window, first, last, times = (np.concatenate(c) for c in zip(*parts, strict=True))
        keys = keys.view(np.uint64)
        order = np.argsort(keys, kind="stable")
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        rest = (c[order] for c in (keys, window, first, last, times))
        return cls(items, contents, owners, np.array(shape, dtype=np.int64).reshape(-1, 2), *rest, bits, [s for s in short if s[1]])

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places whose q-gram some window has, the first entry of each and the number of entries."""
        at = np.flatnonzero(self.bits[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        low = np.searchsorted(self.keys, grams[at], side="left")
        sizes = np.searchsorted(self.keys, grams[at], side="right") - low
        return at[sizes > 0], low[sizes > 0], sizes[sizes > 0]

    def candidates(self, places: np.ndarray, lows: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, lowest diagonal) of the bands that reach the window's bound, from what ``hits`` gives."""
        seen: set[tuple[int, int]] = set()
        for start in range(0, int(places[-1]) + 1 if len(places) else 0, SEGMENT):
            part = slice(*np.searchsorted(places, [start, start + SEGMENT + EDGE]))
            at, low, sizes = places[part], lows[part], numbers[part]
            total = int(sizes.sum())
            if not total:
                continue
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(total)
            place = np.repeat(at, sizes)
            # Each diagonal lies in two bands of twice the step, so every run of budget + 1 diagonals lies in one.
            step = self.shape[self.window[entry], 1] + 1
            lowest = (place - self.last[entry]) // step - 1
            bands = (place - self.first[entry]) // step - lowest + 1
            entry = np.repeat(entry, bands)
            band = np.repeat(lowest - np.concatenate([[0], np.cumsum(bands)[:-1]]), bands) + np.arange(len(entry))
            # A q-gram of the window counts once a band, however often the document has it there.
            base = int(band.min())
            spread = int(band.max()) - base + 1
            entry, band = np.divmod(np.unique(entry * spread + (band - base)), spread)
            window = self.window[entry]
            order = np.argsort(window * spread + band, kind="stable")
            window, band, times = window[order], band[order] + base, self.times[entry[order]]
            edges = np.flatnonzero(run_starts(window) | run_starts(band))
            counts = np.add.reduceat(times, edges)
            shape = self.shape[window[edges]]
            enough = counts >= shape[:, 0] - Q + 1 - shape[:, 1] * Q
            for w, b in zip(window[edges][enough].tolist(), band[edges][enough].tolist(), strict=True):
                if (w, b) not in seen:
                    seen.add((w, b))
                    yield w, b * (int(self.shape[w, 1]) + 1)

    def short_matches(self, whole: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, start, end, length) of the short items, found where they stand alone."""
        if not self.short:
            return
        finder = _finder(tuple(self.short))
        for end, found in finder.iter(whole.decode("latin-1")):
            for item, length in found:
                start = end + 1 - length
                if not (_joins(whole, start - 1, start) or _joins(whole, end, end + 1)):
                    yield item, start, end + 1, length

    def matches(self, data: bytes) -> list[tuple[int, int, int, int, int, int]]:
        """(item_id, start and end in the bytes of the text, start and end in the normal item, edits), merged by item."""
        full, at = normal(data)
        out = [(item, int(at[a]), int(at[b - 1]) + 1, 0, n, 0) for item, a, b, n in self.short_matches(full.tobytes())]
        if len(full) < Q or not len(self.keys):
            return sorted(out)
        text, short = full, None
        hits = self.hits(qgrams(full))
        if not len(hits[0]):
            return sorted(out)
        if int(hits[2].sum()) > CROWDED * len(full):
            short = shortened(full)
            text = short.text
            hits = self.hits(qgrams(text))
        found: dict[int, list[tuple[int, int, int, int, int]]] = {}
        whole = text.tobytes()
        known: set[tuple[int, int]] = set()
        for w, low in self.candidates(*hits):
            pattern, most = self.contents[w], int(self.shape[w, 1])
            length = len(pattern)
            # The two bands a match lies in overlap; an exact match needs no alignment.
            if any((w, low + d) in known for d in range(-most, 3 * most + 3)):
                continue
            exact = whole.find(pattern.tobytes(), max(low, 0), max(low, 0) + 2 * (most + 1) + length)
            aligned = (exact, exact + length, 0) if exact >= 0 else align(pattern, text, low, 2 * (most + 1), most)
            if aligned:
                a, b, edits = aligned
                known.add((w, a))
                place = short.back(a, b) if short else (a, b)
                for number, start in self.owners[w]:
                    found.setdefault(number, []).append((*place, start, start + length, edits))
        for number, parts in sorted(found.items()):
            merged: list[list[int]] = []
            for a, b, c, d, edits in sorted(parts):
                if merged and a <= merged[-1][1]:
                    last = merged[-1]
                    merged[-1] = [last[0], max(last[1], b), min(last[2], c), max(last[3], d), max(last[4], edits)]
                else:
                    merged.append([a, b, c, d, edits])
            out += [(self.items[number][0], int(at[a]), int(at[b - 1]) + 1, c, d, e) for a, b, c, d, e in merged]
        return sorted(out)


@lru_cache(maxsize=4)
def _finder(short: tuple[tuple[int, bytes], ...]) -> ahocorasick.Automaton:
    by_text: dict[bytes, list[tuple[int, int]]] = {}
    for item, text in short:
        by_text.setdefault(text, []).append((item, len(text)))
    finder = ahocorasick.Automaton()
    for text, owners in by_text.items():
        finder.add_word(text.decode("latin-1"), owners)
    finder.make_automaton()
    return finder


def _joins(text: bytes, a: int, b: int) -> bool:
    """Whether neighbouring bytes are both of a word: letters, digits or bytes of other scripts."""
    if a < 0 or b >= len(text):
        return False
    return all(c >= 128 or chr(c).isalnum() for c in (text[a], text[b]))


def align(pattern: np.ndarray, text: np.ndarray, first: int, diagonals: int, most: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole pattern with a stretch of the text that starts on one of the diagonals.

    Returns start, end and edits if the edits are within the budget. Cells lie in a band ``most`` wider than
    the diagonals on both sides.
    """
    m, begin = len(pattern), first - most
    width = diagonals + 2 * most + 1
    # An edit makes up for one byte of the pattern that the text doesn't have, no more.
    have = np.bincount(text[max(begin, 0) : max(begin + m + width, 0)], minlength=256)
    if np.maximum(np.bincount(pattern, minlength=256) - have, 0).sum() > most:
        return None
    reach = np.arange(width)
    huge = 1 << 20
    # The text under the band; places outside the text hold a byte that no text has.
    under = np.full(m + width, 255, dtype=np.uint8)
    inner = text[max(begin, 0) : max(begin + m + width, 0)]
    under[max(-begin, 0) : max(-begin, 0) + len(inner)] = inner
    at_edge = begin < 0 or begin + m + width > len(text)
    # Row r holds the cells (r characters of the pattern, begin + r + c of the text); free start in the text.
    places = begin + reach
    inside = (places >= 0) & (places <= len(text))
    row = np.where(inside, 0, huge)
    source = np.where(inside, places, -1)
    up, up_source = np.full(width, huge), np.full(width, -1)
    for r in range(1, m + 1):
        diagonal = row + (under[r - 1 : r - 1 + width] != pattern[r - 1])
        up[:-1] = row[1:]
        up[:-1] += 1
        up_source[:-1] = source[1:]
        take_up = up < diagonal
        new = np.where(take_up, up, diagonal)
        source = np.where(take_up, up_source, source)
        # Insertions: the smallest of what lies to the left plus the distance.
        level = new - reach
        slid = np.minimum.accumulate(level)
        better = slid < level
        if better.any():
            # The first place where the running minimum was reached holds the origin.
            holder = np.maximum.accumulate(np.where(better, 0, reach))
            source = source[holder]
            new = slid + reach
        if at_edge:
            places = begin + r + reach
            new = np.where((places >= 0) & (places <= len(text)), new, huge)
        row = new
        if row.min() > most:
            return None
    best = int(np.argmin(row))
    if row[best] > most:
        return None
    end = begin + m + best
    return (int(source[best]), end, int(row[best])) if end > int(source[best]) >= 0 else None


# ------------------------------------------------------------------ the operator

SCHEMA = "doc_id bigint, item_id bigint, doc_start bigint, doc_end bigint, item_start bigint, item_end bigint, edits bigint"


def shard_count(benchmark: DataFrame, text: str, most: int = SHARD_BYTES) -> int:
    """So many hash shards of items that each holds about half of ``most`` bytes."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0
    return max(1, -(-2 * size // most))


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """A row for each stretch of a document that matches part of an item. Document places are UTF-8 bytes."""
    spark = ready(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("data"))
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("bigint").alias("item_id"), utf8(item_text).alias("data"))
    count = shard_count(benchmark, item_text)
    found = None
    for number in range(count):
        mine = items.where(F.pmod(F.xxhash64("item_id", "data"), F.lit(count)) == number)
        rows = [(r["item_id"], bytes(r["data"])) for r in mine.orderBy("item_id", "data").collect()]
        shared = spark.sparkContext.broadcast(Index.of(rows))

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                out = [
                    (doc, *match)
                    for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for match in index.matches(data)
                ]
                columns = list(zip(*out, strict=True)) or [()] * 7
                names = ["doc_id", "item_id", "doc_start", "doc_end", "item_start", "item_end", "edits"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        part = source.mapInArrow(step, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak of an item of ``LEAST_ITEM`` bytes or more, whole rows."""
    found = leaks(docs, benchmark).where((F.col("item_end") - F.col("item_start") >= LEAST_ITEM))
    ids = staged(found.select("doc_id").distinct(), "leaky")
    likely, rest = split_by_ids(docs, ids, ids.count())
    return likely.join(ids, "doc_id", "left_anti").select(*docs.columns).unionByName(rest.select(*docs.columns))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, table(spark, sf_dir, "benchmark"))
