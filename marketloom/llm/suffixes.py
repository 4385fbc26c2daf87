"""Repeated byte strings by a depth-limited radix sort of suffixes, most significant digit first.

Every position with ``depth`` bytes left in its document begins a suffix, cut at ``depth``. Suffixes are
told apart digit by digit, in Spark's shuffles, and those that are alone under their digits so far leave; the
groups left at full depth are exactly the repeated strings.

The first digit is chosen by content: of the ``core``-byte strings inside the suffix, the one with the
smallest hash (the leftmost of equals). Equal suffixes have the same one at the same place, and neighbouring
suffixes share it, so a run of up to ``depth - core + 1`` suffixes is one row of the first passes
instead of one each. First pass: the core; runs whose core occurs once leave (a bounded Bloom
filter of the repeated cores keeps them from being shuffled). Second pass: all bytes of the run; a run that
equals an earlier one is repeated from end to end, and only the first of equal runs goes on, if its core also
has other surroundings. Last pass: the single suffixes of those runs, through all ``depth`` bytes. The second and
the last pass are one shuffle each, sorted within partitions and read once.

Runs and suffixes are compared by 128-bit hashes of their bytes.

Defined cases: null or empty texts, and those shorter than ``depth``, keep all bytes; matches never cross
documents; earlier means a smaller doc_id, or an earlier start in the same document; rows with one doc_id and
one text are one document, rows with one doc_id and different texts are documents of their own, ordered by a hash of
the text; rows without doc_id come back whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bloom import Filter, blocks_for, filter_rows, may_hold, split_by_ids
from marketloom.llm.common import gathered, mix64, run_starts, staged, table, utf8

DEPTH = 100
CORE = 64

# Odd multipliers and random values of bytes for two polynomial hashes modulo 2 to the 64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_VALUES = tuple(mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * k)) for k in range(2))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        factors = np.full(n, b, dtype=np.uint64)
        factors[:1] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


_POWERS: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _POWERS or _POWERS[which][0] < n:
        size = max(1 << 16, 1 << n.bit_length())
        _POWERS[which] = (size, *_powers(_BASES[which], size))
    _, up, down = _POWERS[which]
    return up[:n], down[:n]


class Hashes:
    """Hashes of any stretch of some bytes; each of the two sums is made when first asked for."""

    def __init__(self, data: bytes) -> None:
        self.raw = np.frombuffer(data, dtype=np.uint8)
        self._sums: dict[int, np.ndarray] = {}

    def sums(self, which: int) -> np.ndarray:
        if which not in self._sums:
            raw = self.raw
            _, down = powers(which, len(raw) + 1)
            total = np.zeros(len(raw) + 1, dtype=np.uint64)
            np.cumsum(_VALUES[which][raw] * down[: len(raw)], out=total[1:])
            self._sums[which] = total
        return self._sums[which]

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        sums = self.sums(which)
        up, _ = powers(which, len(sums))
        return mix64((sums[end] - sums[start]) * up[start] + (end - start).astype(np.uint64))

    def all_of(self, length: int, which: int = 0) -> np.ndarray:
        """A number for the stretch of this length from every place, before it is scrambled."""
        sums = self.sums(which)
        n = len(sums) - length
        up, _ = powers(which, len(sums))
        out = sums[length:] - sums[:n]
        out *= up[:n]
        out += np.uint64(length)
        return out


#: Bytes of texts that are hashed together, so that short texts share the calls.
TOGETHER = 1 << 17


def together(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``TOGETHER`` bytes, or one longer text."""
    first = size = 0
    for k, data in enumerate(texts):
        if size and size + len(data) > TOGETHER:
            yield first, k
            first, size = k, 0
        size += len(data)
    if first < len(texts):
        yield first, len(texts)


@dataclass
class Runs:
    """Runs of suffixes with the same core in some texts; places are counted over all of these texts."""

    hashes: Hashes
    bounds: np.ndarray  # where each text starts, and the end
    cores: np.ndarray
    place: np.ndarray  # of the core
    first: np.ndarray
    last: np.ndarray

    def taken(self, keep: np.ndarray) -> Runs:
        return Runs(self.hashes, self.bounds, *(c[keep] for c in (self.cores, self.place, self.first, self.last)))

    def whole(self, depth: int) -> np.ndarray:
        """Hash of a run's bytes and of the core's place among them."""
        whole = self.hashes.of(self.first, self.last + depth, 1)
        return mix64(whole + (self.place - self.first).astype(np.uint64))

    def text(self) -> np.ndarray:
        """Number of the text a run lies in."""
        return np.searchsorted(self.bounds, self.first, side="right") - 1


def runs(texts: list[bytes], depth: int = DEPTH, core: int = CORE) -> Runs | None:
    """The runs of some texts, none of which crosses from one text to the next."""
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in texts])]).astype(np.int64)
    n = int(bounds[-1])
    if n < depth:
        return None
    hashes = Hashes(b"".join(texts))
    grams = hashes.all_of(core)
    # The order of cores needs scrambled high bits only.
    low = grams ^ (grams >> np.uint64(32))
    low *= np.uint64(0xBF58476D1CE4E5B9)
    low &= np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(len(grams), dtype=np.uint64)
    # Sliding minimum over ``depth - core + 1`` positions, by doubling.
    width, have = depth - core + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    # Suffixes that end in their own text; a core inside one does too, so texts never share a run.
    inside = np.ones(len(low), dtype=bool)
    for end in bounds[1:-1].tolist():
        inside[max(end - depth + 1, 0) : end] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return None
    place = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edges = np.flatnonzero(run_starts(place))
    last = starts[np.concatenate([edges[1:], [len(place)]]) - 1]
    return Runs(hashes, bounds, mix64(grams[place[edges]]), place[edges], starts[edges], last)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _run_cores(docs: DataFrame, depth: int, core: int) -> DataFrame:
    """Cores with the number of runs, added up over some texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 2048):
            texts = batch.column(0).to_pylist()
            found = [r.cores for r in (runs(texts[a:b], depth, core) for a, b in together(texts)) if r]
            cores, counts = np.unique(np.concatenate([*found, np.zeros(0, dtype=np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(cores), pa.array(counts, pa.int64())], names=["core", "n"])

    return docs.select("data").mapInArrow(step, "core bigint, n bigint")


RUNS = "core bigint, whole bigint, doc_id bigint, tag bigint, first int, last int, copy boolean"
MARKS = "doc_id bigint, tag bigint, start int, end int, open boolean"


def _repeated_runs(docs: DataFrame, passing: Filter, depth: int, core: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(passing)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in range(6)]
            doc, tag = (batch.column(i).to_numpy() for i in (0, 1))
            texts = batch.column(2).to_pylist()
            for a, b in together(texts):
                found = runs(texts[a:b], depth, core)
                if found is None:
                    continue
                found = found.taken(shared.value.hits(found.cores))
                row = found.text()
                start = found.bounds[row]
                parts = (found.cores, found.whole(depth), doc[a + row], tag[a + row], found.first - start, found.last - start)
                for column, part in zip(columns, parts, strict=True):
                    column.append(part.view(np.int64))
            core_hash, whole, ids, tags, first, last = (np.concatenate(c) for c in columns)
            # Equal runs of these documents meet here already: text that repeats itself is no hot group later.
            order = np.lexsort((first, tags, ids, whole, core_hash))
            core_hash, whole, ids, tags, first, last = (c[order] for c in (core_hash, whole, ids, tags, first, last))
            copy = ~(run_starts(core_hash) | run_starts(whole))
            again = copy & ~(run_starts(ids) | run_starts(tags) | run_starts(first))
            # Copies are known as such and only have to travel with the rest, spread evenly.
            places = mix64(ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + first.view(np.uint64)).view(np.int64)
            core_hash = np.where(copy, places, core_hash)
            joined = [c[~again] for c in (core_hash, whole, ids, tags, first, last, copy)]
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(joined, kinds, strict=True)],
                names=["core", "whole", "doc_id", "tag", "first", "last", "copy"],
            )

    return docs.select("doc_id", "tag", "data").mapInArrow(step, RUNS)


def _told_apart(found: DataFrame, depth: int) -> DataFrame:
    """Runs by what is known of them: spans that are copies of an earlier run, and runs still open.

    Runs are sorted by core, bytes and place, and read once: behind the first of equal runs come its copies; the
    first is open where its core has other bytes around it somewhere. No group is held, so a core may have any
    number of runs.
    """

    def marked(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        for ids, tags, start, end, flag in parts:
            if len(ids):
                numbers = [pa.array(ids, pa.int64()), pa.array(tags, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [*numbers, pa.array(np.full(len(ids), flag))], names=["doc_id", "tag", "start", "end", "open"]
                )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # core and bytes of the row before
        pending: tuple | None = None  # a core's first run, whose core may still show other bytes
        for batch in batches:
            core, whole, doc, tag, first, last, copy = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            out = [(doc[copy], tag[copy], first[copy], last[copy] + depth, False)]
            core, whole, doc, tag, first, last = (c[~copy] for c in (core, whole, doc, tag, first, last))
            # A place met twice, from repeated rows, is one place.
            fresh = run_starts(whole) | run_starts(doc) | run_starts(tag) | run_starts(first)
            fresh[:1] = before is None or not len(core) or (whole[0], doc[0], tag[0], first[0]) != before[1:]
            core, whole, doc, tag, first, last = (c[fresh] for c in (core, whole, doc, tag, first, last))
            if not len(core):
                yield from marked(out)
                continue
            new_core, new_run = run_starts(core), np.ones(len(core), dtype=bool)
            new_run[1:] = new_core[1:] | (whole[1:] != whole[:-1])
            if before is not None:
                new_core[0] = core[0] != before[0]
                new_run[0] = new_core[0] or whole[0] != before[1]
            before = core[-1], whole[-1], doc[-1], tag[-1], first[-1]
            firsts = np.flatnonzero(new_run)
            alone = new_core[firsts]
            follows = np.append(alone[1:], True)  # whether the next first run begins another core
            still_open = firsts[~alone | ~follows]
            out.append((doc[~new_run], tag[~new_run], first[~new_run], last[~new_run] + depth, False))
            if len(firsts):
                if pending is not None and not alone[0]:
                    out.append((*(np.array([x]) for x in pending), True))
                pending = None
                if alone[-1]:
                    k = firsts[-1]
                    pending = doc[k], tag[k], first[k], last[k]
            out.append((doc[still_open], tag[still_open], first[still_open], last[still_open], True))
            yield from marked(out)

    ordered = found.repartition("core").sortWithinPartitions("core", "whole", "doc_id", "tag", "first")
    return ordered.mapInArrow(step, MARKS)


def _single_suffixes(docs: DataFrame, depth: int) -> DataFrame:
    """All suffixes of the open runs (column ``open``: first and last starts): two hashes, document and start."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, tag, data, open_runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = Hashes(data)
                starts = np.concatenate([np.arange(r["start"], r["end"] + 1) for r in open_runs])
                starts = starts[starts + depth <= len(data)]
                yield pa.RecordBatch.from_arrays(
                    [_signed(hashes.of(starts, starts + depth, 0)), _signed(hashes.of(starts, starts + depth, 1)),
                     pa.array(np.full(len(starts), doc_id), pa.int64()), pa.array(np.full(len(starts), tag), pa.int64()),
                     pa.array(starts, pa.int32())],
                    names=["one", "two", "doc_id", "tag", "start"],
                )

    found = docs.select("doc_id", "tag", "data", "open")
    return found.mapInArrow(step, "one bigint, two bigint, doc_id bigint, tag bigint, start int")


def _later_suffixes(suffixes: DataFrame, depth: int) -> DataFrame:
    """Spans of all but the first of equal suffixes, from one pass over them in order."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            one, two, doc, tag, start = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(one):
                continue
            same = ~(run_starts(one) | run_starts(two))
            same[0] = before is not None and (one[0], two[0]) == before[:2]
            # A place met twice is one place.
            again = same & ~(run_starts(doc) | run_starts(tag) | run_starts(start))
            again[0] = same[0] and (doc[0], tag[0], start[0]) == before[2:]
            before = one[-1], two[-1], doc[-1], tag[-1], start[-1]
            keep = same & ~again
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[keep], pa.int64()), pa.array(tag[keep], pa.int64()), pa.array(start[keep], pa.int32()),
                 pa.array(start[keep] + depth, pa.int32())],
                names=["doc_id", "tag", "start", "end"],
            )

    ordered = suffixes.repartition("one").sortWithinPartitions("one", "two", "doc_id", "tag", "start")
    return ordered.mapInArrow(step, "doc_id bigint, tag bigint, start int, end int")


def tagged(docs: DataFrame) -> DataFrame:
    """The documents with ``tag``, which tells texts of one doc_id apart: 0 where an id has one text only.

    Ids with several texts are few as a rule; the Bloom filter that holds them is bounded, and an id it lets
    pass by mistake gets the same tag on all its rows.
    """
    per_id = docs.where("doc_id IS NOT NULL").groupBy("doc_id")
    digests = per_id.agg(F.min(F.xxhash64("data")).alias("low"), F.max(F.xxhash64("data")).alias("high"))
    several = staged(digests.where("low <> high").select(F.xxhash64("doc_id").alias("key")), "several_texts")
    count = several.count()
    if not count:
        return docs.withColumn("tag", F.lit(0).cast("bigint"))
    blocks = blocks_for(count)
    marked = may_hold(docs, F.xxhash64("doc_id"), filter_rows(several, "key", blocks), blocks)
    return marked.withColumn("tag", F.when(F.col("_may"), F.xxhash64("data")).otherwise(F.lit(0).cast("bigint"))).drop("_may")


def repeated_spans(docs: DataFrame, depth: int = DEPTH, core: int = CORE) -> DataFrame:
    """doc_id, tag, start and end (bytes, end exclusive) of stretches covered by strings that start earlier too.

    ``docs`` has doc_id, tag and data (bytes). Spans of one document may overlap.
    """
    docs = docs.where("doc_id IS NOT NULL")
    cores = _run_cores(docs, depth, core).groupBy("core").agg(F.sum("n").alias("n")).where("n > 1").select("core")
    cores = staged(cores, "cores")
    blocks = blocks_for(cores.count())
    passing = Filter(filter_rows(cores, "core", blocks), blocks)
    found = _repeated_runs(docs, passing, depth, core)
    marks = staged(_told_apart(found, depth), "marks")
    open_runs = marks.where("open").groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("open"))
    open_runs = staged(open_runs, "open_runs")
    likely, _ = split_by_ids(docs.select("doc_id", "tag", "data"), open_runs.select("doc_id"), open_runs.count())
    suffixes = _single_suffixes(likely.join(open_runs, ["doc_id", "tag"]), depth)
    return marks.where("NOT open").select("doc_id", "tag", "start", "end").unionByName(_later_suffixes(suffixes, depth))


# ------------------------------------------------------------------ the operator


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, depth: int = DEPTH, text: str = "text") -> DataFrame:
    """doc_id, data (the bytes kept), n_bytes (of the input), n_removed, n_spans: a row for each row of ``docs``."""
    source = tagged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8(text).alias("data")))
    # One document for each doc_id and text; a repeated row is no earlier place of itself.
    spans = staged(repeated_spans(source, depth), "spans")
    per_doc = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    per_doc = staged(per_doc, "spans_by_doc")
    likely, whole = split_by_ids(source, per_doc.select("doc_id"), per_doc.count())
    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = likely.join(per_doc, ["doc_id", "tag"], "left").select("doc_id", "data", F.coalesce("spans", none).alias("spans"))
    rows = joined.unionByName(whole.select("doc_id", "data", none.alias("spans")))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, counted = [], [], []
            for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                merged = [s for s in _merged(spans) if s[0] < len(data)]
                parts, last = [], 0
                for start, end in merged:
                    parts.append(data[last:start])
                    last = end
                kept.append(b"".join([*parts, data[last:]]))
                removed.append(len(data) - len(kept[-1]))
                counted.append(len(merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array([len(k) + r for k, r in zip(kept, removed, strict=True)], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(counted, pa.int64())],
                names=["doc_id", "data", "n_bytes", "n_removed", "n_spans"],
            )

    return rows.mapInArrow(step, "doc_id bigint, data binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("data", 256).alias("kept_sha256"))
