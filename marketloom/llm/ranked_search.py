"""Ranked lexical search by Block-Max MaxScore over an index of compressed postings.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case. With N
documents that have a term, L terms in all of them and df documents that hold a term, the term weighs
``floor(1000 ln((2N + 2) / (2 df + 1)))``, an occurrence count tf in a document of n terms adds the weight times
``10^9 tf div (1000 tf + 12 m)`` with ``m = 75 + 25 n N div L``; all but the logarithm is in 64-bit integers.

* **Index.** One pass counts N and L, which the block maxima need. A second pass makes index segments where the documents lie,
  without a shuffle: each task gathers whole documents until a segment is full (``SEGMENT_POSTINGS``) and passes on one row
  for each term of it, with postings in blocks of ``BLOCK`` as variable-length bytes, the last document and the largest
  addition of every block, and the bytes' offsets. All terms of all documents are indexed.
* **Search.** The items' terms are joined with the index; a segment and a batch of at most ``BATCH_ITEMS`` items meet in one
  group, whose size the two bounds limit. Within it each item's lists are ordered by their largest addition. Lists whose
  sum of bounds can't lift a document into the best k are non-essential; only documents of the others, the essential ones, are
  candidates. Documents are visited in windows, so that the bound rises on the way; a candidate whose sum so far, plus the block
  maximum at its place in a non-essential list, plus the bounds of the lists below, can't reach the k-th score is given up
  before that block is decompressed.
* **Merge.** Each segment passes on its k best documents for each item (its heap); a top-k for each item merges them, cut
  to k rows in every task before the shuffle.

Defined cases: null and empty texts, and texts without terms, are not counted and found by nothing; items without terms, or whose
terms occur nowhere or weigh 0, give no rows; a term repeated in an item counts each time; rows that share an item_id are
one item with the terms of all; rows that share a doc_id are documents of their own; equal scores go by doc_id, rows
without one last; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bloom import blocks_for, filter_rows, may_hold
from marketloom.llm.common import ready, staged, table, utf8
from marketloom.operators.reports import top_k_per_key

BEST = 20
BLOCK = 128
#: Postings of an index segment; a document is never divided.
SEGMENT_POSTINGS = 1 << 21
BATCH_ITEMS = 256
#: Documents of a segment that are scored at once.
WINDOW = 2048
#: Bytes of a text that are divided into terms at once.
CHUNK = 1 << 20

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_IN_TERM[128:] = True


# ------------------------------------------------------------------ terms


def count_terms(data: bytes) -> int:
    """How many terms a text has, without making them."""
    inside = _IN_TERM[np.frombuffer(data, dtype=np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + bool(len(inside) and inside[0])


def term_counts(data: bytes) -> Counter:
    """Terms of a text with their number of occurrences."""
    if len(data) <= CHUNK:
        return Counter(_TERM.findall(data.lower()))
    out: Counter = Counter()
    start = 0
    while start < len(data):
        end = min(len(data), start + CHUNK)
        while end < len(data) and _IN_TERM[data[end]] and _IN_TERM[data[end - 1]]:
            end += 1
        out.update(_TERM.findall(data[start:end].lower()))
        start = end
    return out


# ------------------------------------------------------------------ compressed postings


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits to a byte, low ones first, the high bit on all but the last byte; and the bytes of each value."""
    sizes = np.ones(len(values), dtype=np.int64)
    for step in range(1, 9):
        sizes += values >= (1 << (7 * step))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for step in range(int(sizes.max()) if len(sizes) else 0):
        has = np.flatnonzero(sizes > step)
        more = np.where(sizes[has] > step + 1, 128, 0)
        out[ends[has] - sizes[has] + step] = ((values[has] >> (7 * step)) & 127) | more
    return out, sizes


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


class Segment:
    """Gathers documents; ``rows`` gives the index rows of the segment."""

    def __init__(self, total: int, terms: int) -> None:
        self.total, self.terms = total, terms
        self.number: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.lists: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.postings = 0

    def add(self, doc: int | None, data: bytes) -> None:
        counts = term_counts(data)
        if not counts:
            return
        number = self.number
        self.lists.append(np.array([number.setdefault(t, len(number)) for t in counts], dtype=np.int32))
        tf = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
        self.tfs.append(tf)
        self.ids.append(doc)
        self.lengths.append(int(tf.sum()))
        self.postings += len(tf)

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        # Places go by doc_id, so of equal scores the one met first stays.
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0, i))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array(self.lengths, dtype=np.int64)
        sizes = np.fromiter((len(x) for x in self.lists), dtype=np.int64, count=len(self.lists))
        docs, tf, lists = np.repeat(place, sizes), np.concatenate(self.tfs), np.concatenate(self.lists).astype(np.int64)
        gain = additions(tf, np.repeat(lengths, sizes), self.total, self.terms)
        by = np.lexsort((docs, lists))
        docs, tf, lists, gain = docs[by], tf[by], lists[by], gain[by]

        at = np.arange(len(lists))
        first = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]]))
        inside = at - np.repeat(first, np.diff(np.append(first, len(lists))))
        heads = np.flatnonzero(inside % BLOCK == 0)
        # The first posting of a block holds its document, the others the distance to the one before.
        delta = np.concatenate([[0], np.diff(docs)])
        delta[heads] = docs[heads]
        data, widths = packed(np.column_stack([delta, tf]).reshape(-1))
        offset = np.concatenate([[0], np.cumsum(widths.reshape(-1, 2).sum(axis=1))])
        tails = np.append(heads[1:], len(lists)) - 1
        last, top = docs[tails].astype(np.int32), np.maximum.reduceat(gain, heads).astype(np.int32)
        block_of = np.searchsorted(heads, first)
        blocks = np.append(block_of, len(heads))
        list_start = offset[np.append(first, len(lists))]
        begin = (offset[heads] - np.repeat(list_start[:-1], np.diff(blocks))).astype(np.int32)
        names = list(self.number)
        most = np.maximum.reduceat(top, block_of)

        def column(values: np.ndarray, edges: np.ndarray) -> pa.Array:
            edges = (edges * values.itemsize).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(values)])

        count = len(names)
        yield _index_batch(
            segment=pa.array([name] * count),
            term=pa.array(names, pa.binary()),
            df=pa.array(np.diff(np.append(first, len(lists)))),
            most=pa.array(most.astype(np.int64)),
            last=column(last, blocks),
            top=column(top, blocks),
            begin=column(begin, blocks),
            data=column(data, list_start),
            ids=pa.nulls(count, pa.list_(pa.int64())),
            lengths=pa.nulls(count, pa.list_(pa.int64())),
        )
        yield _index_batch(
            segment=pa.array([name]),
            term=pa.nulls(1, pa.binary()),
            df=pa.array([len(order)], pa.int64()),
            most=pa.nulls(1, pa.int64()),
            last=pa.nulls(1, pa.binary()),
            top=pa.nulls(1, pa.binary()),
            begin=pa.nulls(1, pa.binary()),
            data=pa.nulls(1, pa.binary()),
            ids=pa.array([[self.ids[i] for i in order]], pa.list_(pa.int64())),
            lengths=pa.array([lengths[order]], pa.list_(pa.int64())),
        )


_INDEX = (
    "segment string, term binary, df bigint, most bigint, last binary, top binary, begin binary, data binary, "
    "ids array<bigint>, lengths array<bigint>"
)


def _index_batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def additions(tf: np.ndarray, lengths: np.ndarray, total: int, terms: int) -> np.ndarray:
    """What a unit of weight adds for these occurrence counts in documents of these lengths."""
    m = 75 + (25 * lengths * total) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


# ------------------------------------------------------------------ the index


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Documents with a term, and terms in all."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                n = count_terms(data)
                docs += n > 0
                terms += n
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])

    sums = docs.select(utf8(text).alias("data")).mapInArrow(step, "docs bigint, terms bigint")
    row = sums.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    return row["docs"] or 0, row["terms"] or 0


def build_index(
    docs: DataFrame, total: int, terms: int, segment_postings: int = SEGMENT_POSTINGS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The index rows of all documents: one for each segment and term, and one with the documents of each segment."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, name = Segment(total, terms), None
        for batch in batches:
            parts, ids, texts = (c.to_pylist() for c in batch.columns)
            for part, doc, data in zip(parts, ids, texts, strict=True):
                # The number of a segment's first row in its task names it, also when the task runs again.
                name = part if name is None else name
                segment.add(doc, data)
                if segment.postings >= segment_postings:
                    yield from segment.rows(str(name))
                    segment, name = Segment(total, terms), None
        yield from segment.rows(str(name))

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("data")
    )
    return rows.mapInArrow(step, _INDEX)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The terms of every item with their number of occurrences."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out += [(item, term, n) for term, n in term_counts(data).items()]
            columns = list(zip(*out, strict=True)) if out else [(), (), ()]
            types = (pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item_id", "term", "times"]
            )

    rows = items.select(F.col(item_id).cast("bigint").alias("item_id"), utf8(text).alias("data"))
    counted = rows.mapInArrow(step, "item_id bigint, term binary, times bigint")
    return counted.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


# ------------------------------------------------------------------ search


class PostingList:
    """One item's view of a term's list in a segment; decompresses blocks when they are asked for."""

    def __init__(self, weight: int, most: int, last: bytes, top: bytes, begin: bytes, data: bytes, work: Counter) -> None:
        self.weight, self.bound = weight, weight * most
        self.last, self.top = np.frombuffer(last, dtype=np.int32), np.frombuffer(top, dtype=np.int32)
        self.begin = np.append(np.frombuffer(begin, dtype=np.int32), len(data))
        self.data = np.frombuffer(data, dtype=np.uint8)
        self.work = work
        self.held: tuple[int, tuple[np.ndarray, np.ndarray]] = (-1, (self.last[:0], self.last[:0]))

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and occurrence counts of a block; the last one is kept, as windows may end inside it."""
        if self.held[0] != i:
            pairs = unpacked(self.data[self.begin[i] : self.begin[i + 1]])
            self.held = (i, (np.cumsum(pairs[0::2]), pairs[1::2]))
            self.work["blocks"] += 1
        return self.held[1]

    def within(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings of the documents from start to before end."""
        low, high = np.searchsorted(self.last, start), np.searchsorted(self.last, end - 1)
        found = [self.block(i) for i in range(low, min(high + 1, len(self.last)))]
        if not found:
            return self.last[:0], self.last[:0]
        docs, tf = (np.concatenate(x) for x in zip(*found, strict=True))
        inside = (docs >= start) & (docs < end)
        return docs[inside], tf[inside]


def best_in_segment(lists: list[PostingList], m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best documents of a segment for one item, equal scores by place."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    below = np.concatenate([[0], np.cumsum([x.bound for x in lists])])
    places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    floor = 0
    for start in range(0, len(m), WINDOW):
        end = min(len(m), start + WINDOW)
        # Lists whose bounds together don't pass the k-th score are non-essential. Later places lose ties.
        split = int(np.searchsorted(below[1:], floor, side="right"))
        if split == len(lists):
            break
        sums = np.zeros(end - start, dtype=np.int64)
        for x in lists[split:]:
            docs, tf = x.within(start, end)
            sums[docs - start] += x.weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[docs]))
        found = np.flatnonzero(sums)
        for i in range(split - 1, -1, -1):
            found = found[sums[found] + below[i + 1] > floor]
            if not len(found):
                break
            x = lists[i]
            at = np.searchsorted(x.last, found + start)
            has = at < len(x.last)
            local = np.where(has, x.weight * x.top[np.minimum(at, len(x.last) - 1)].astype(np.int64), 0)
            may = sums[found] + local + below[i] > floor
            found, at, has = found[may], at[may], has[may]
            for b in np.unique(at[has]):
                docs, tf = x.block(int(b))
                mine = found[has & (at == b)]
                where = np.searchsorted(docs, mine + start)
                hit = docs[np.minimum(where, len(docs) - 1)] == mine + start
                doc, n = mine[hit], tf[where[hit]]
                sums[doc] += x.weight * ((1_000_000_000 * n) // (1000 * n + 12 * m[doc + start]))
        found = found[sums[found] > floor]
        places, scores = np.concatenate([places, found + start]), np.concatenate([scores, sums[found]])
        order = np.argsort(-scores, kind="stable")[:k]
        places, scores = places[order], scores[order]
        floor = int(scores[-1]) if len(scores) == k else 0
    return places, scores


def search(index: DataFrame, items: DataFrame, total: int, terms: int, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item. ``items`` has item_id and text."""
    wanted = staged(item_terms(items), "item_terms")
    # A bounded filter of the items' terms keeps the other lists out of the shuffles; the joins are exact.
    sought = wanted.select(F.xxhash64("term").alias("key")).distinct()
    blocks = blocks_for(sought.count())
    may = may_hold(index.where("term IS NOT NULL"), F.xxhash64("term"), filter_rows(sought, "key", blocks), blocks)
    lists = may.where("_may").drop("_may")
    df = lists.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * total + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weighed = wanted.join(df.select("term", weight.alias("weight")).where("weight > 0"), "term")
    # A hash deals the items over the batches; a batch's users of a term are few enough for one row.
    count = max(1, wanted.select("item_id").distinct().count())
    batches = -(-count // BATCH_ITEMS)
    batch = F.pmod(F.xxhash64("item_id"), F.lit(batches)).cast("int")
    user = F.struct("item_id", (F.col("weight") * F.col("times")).alias("weight"))
    users = weighed.groupBy(batch.alias("batch"), "term").agg(F.collect_list(user).alias("users"))
    postings = lists.join(users, "term").drop("term", "df")
    every = F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch")
    documents = index.where("term IS NULL").select("segment", every, "ids", "lengths")

    def step(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        documents = [r for r in rows if r["ids"] is not None]
        lists: dict[int | None, list[PostingList]] = {}
        work: Counter = Counter()
        for r in rows:
            for user in r["users"] or ():
                one = PostingList(user["weight"], r["most"], r["last"], r["top"], r["begin"], r["data"], work)
                lists.setdefault(user["item_id"], []).append(one)
        out: list[tuple] = []
        for r in documents:
            m = 75 + (25 * np.array(r["lengths"], dtype=np.int64) * total) // terms
            for item, own in lists.items():
                places, scores = best_in_segment(own, m, k)
                out += [(item, r["ids"][p], s) for p, s in zip(places.tolist(), scores.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    heaps = postings.unionByName(documents, allowMissingColumns=True).groupBy("segment", "batch").applyInArrow(step, "item_id bigint, doc_id bigint, score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return top_k_per_key(heaps, ["item_id"], order, k, "rank").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = BEST, segment_postings: int = SEGMENT_POSTINGS) -> DataFrame:
    """Index all documents and search every item."""
    ready(docs.sparkSession)
    total, terms = corpus_size(docs)
    index = staged(build_index(docs, total, max(1, terms), segment_postings), "search_index")
    return search(index, items, total, max(1, terms), k)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The pattern and the numbers are fixed by the query's definition.
OP12_SQL = r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), sized AS (SELECT doc_id, r, ts, len(ts) AS n FROM terms WHERE len(ts) > 0
), corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), postings AS (
  SELECT doc_id, r, n, t, count(*) AS tf FROM (SELECT doc_id, r, n, unnest(ts) AS t FROM sized) GROUP BY ALL
), dfs AS (SELECT t, count(*) AS df FROM postings GROUP BY t
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM dfs, corpus
), items AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE text IS NOT NULL)
  GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, r,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM items JOIN weights USING (t) JOIN postings USING (t), corpus
  GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
