"""Best-fit decreasing packing of token sequences.

Sequences hold at most ``capacity`` tokens, so bins differ by nothing but their remaining capacity and
pieces by nothing but their length. Best-fit decreasing therefore needs only the number of pieces of each
length, a table of ``capacity`` rows however large the corpus is. The plan places length after
length, longest first, into the tightest open bin: a segment tree over the remaining capacities finds it
in logarithmic time. Bins with the same history are placed as one group, so the plan is short and equals what
placing piece after piece gives.

Pieces then learn their place without meeting in one task: each has a rank among the pieces of its
length (its number within the task that cut it plus the counts of the tasks before), and the plan maps length and
rank to sequence and offset. Cut pieces are stored first, so their numbers can't change when a task runs again.

Defined cases: null text is empty and gives one piece that holds the closing id only; texts longer than
the capacity are cut into full pieces, the first being the shorter one; equal pieces get different
places; an empty table gives no rows; repeated documents are packed each.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.llm.common import staged, table

CAPACITY = 1024
END_ID = 2

_NOT_LATIN = re.compile("[^\n -~\xa1-\u024f]")


# ------------------------------------------------------------------ the plan


class TightestFit:
    """Open bins by remaining capacity, with a segment tree that finds the smallest one that suffices."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [False] * (2 * self.size)
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def add(self, remaining: int, first: int, bins: int) -> None:
        if remaining == 0 or bins == 0:
            return
        groups = self.groups.setdefault(remaining, [])
        groups.append((first, bins))
        node = remaining + self.size
        while node and not self.tree[node]:
            self.tree[node] = True
            node //= 2

    def find(self, least: int) -> int | None:
        """The smallest remaining capacity of ``least`` or more that some open bin has."""
        node = least + self.size
        if self.tree[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def take(self, remaining: int) -> tuple[int, int]:
        """Remove one group of bins with this remaining capacity."""
        groups = self.groups[remaining]
        group = groups.pop()
        if not groups:
            node = remaining + self.size
            self.tree[node] = False
            node //= 2
            while node:
                self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]
                node //= 2
        return group


@dataclass(frozen=True)
class Plan:
    """Arrays with one entry for each run of equal placements, sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    per_bin: np.ndarray
    used: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces with these lengths and ranks."""
        top = int(rank.max(initial=0)) + int(self.rank.max(initial=0)) + 1
        at = np.searchsorted(self.length * top + self.rank, length * top + rank, side="right") - 1
        inside = rank - self.rank[at]
        return self.bin[at] + inside // self.per_bin[at], self.used[at] + (inside % self.per_bin[at]) * length


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where best-fit decreasing puts ``counts[length]`` pieces of every length."""
    fit, rows, bins = TightestFit(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = fit.find(length)
            if remaining is None:
                # New bins; while they are the tightest that suffice they are filled one by one.
                per = capacity // length
                whole, rest = divmod(left, per)
                if whole:
                    rows.append((length, rank, bins, per, 0))
                    fit.add(capacity - per * length, bins, whole)
                if rest:
                    rows.append((length, rank + whole * per, bins + whole, rest, 0))
                    fit.add(capacity - rest * length, bins + whole, 1)
                bins += whole + (rest > 0)
                left = 0
                break
            first, size = fit.take(remaining)
            per = remaining // length
            whole, rest = divmod(min(left, size * per), per)
            if whole:
                rows.append((length, rank, first, per, capacity - remaining))
                fit.add(remaining - per * length, first, whole)
            if rest:
                rows.append((length, rank + whole * per, first + whole, rest, capacity - remaining))
                fit.add(remaining - rest * length, first + whole, 1)
            untouched = size - whole - (rest > 0)
            if untouched:
                fit.add(remaining, first + whole + (rest > 0), untouched)
            rank += whole * per + rest
            left -= whole * per + rest
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5)
    columns = columns[np.lexsort((columns[:, 1], columns[:, 0]))]
    return Plan(*(columns[:, i].copy() for i in range(5)), bins)


# ------------------------------------------------------------------ tokens

_TOKENIZERS: dict = {}


def ranked_encoding(path: str):
    """The same vocabulary as merge ranks, for a library that is faster on words it meets for the first time."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextTokenizer:
    """Ids of texts as bytes (unsigned 32-bit, little-endian).

    With ``ranks_path``, texts of Latin script are encoded from the vocabulary's merge ranks, which give the
    same ids in a third of the time; for other scripts and unusual white space the two libraries' character
    classes might differ, so those go to the tokenizer itself, as do texts that hold the name of a special token, which
    is that token there.
    """

    def __init__(self, path: str, ranks_path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = ranked_encoding(ranks_path) if ranks_path else None

    def ids(self, texts: list[str]) -> list[bytes]:
        slow = [self.quick is None or bool(_NOT_LATIN.search(t)) or any(s in t for s in self.special) for t in texts]
        found = self.tokenizer.encode_batch_fast([t for t, s in zip(texts, slow, strict=True) if s], add_special_tokens=False)
        rest = iter([np.array(e.ids, dtype="<u4").tobytes() for e in found])
        return [
            next(rest) if s else self.quick.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes()
            for t, s in zip(texts, slow, strict=True)
        ]


def worker_tokenizer(path: str, ranks_path: str | None = None) -> TextTokenizer:
    if (path, ranks_path) not in _TOKENIZERS:
        _TOKENIZERS[path, ranks_path] = TextTokenizer(path, ranks_path)
    return _TOKENIZERS[path, ranks_path]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, shard int, nth bigint"


def cut_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, text: str = "text", ranks_path: str | None = None
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length and ids (bytes of unsigned 32-bit).

    ``shard`` is the number of the task and ``nth`` counts the pieces of each length in it.
    """
    source = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path, ranks_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        shard, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            doc, piece, start, length, ids, nth = [], [], [], [], [], []
            texts = batch.column(1).to_pylist()
            for doc_id, data in zip(batch.column(0).to_pylist(), tokenizer.ids(texts), strict=True):
                data += end
                n = len(data) // 4
                first = n % capacity or capacity
                edges = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(data[4 * a : 4 * b])
                    nth.append(seen[b - a])
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([shard] * len(doc), pa.int32()),
                 pa.array(nth, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "shard", "nth"],
            )

    return source.mapInArrow(step, PIECES)


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; needs columns ``length`` and ``shard`` and ``nth``.

    ``shard`` and ``nth`` number the pieces of one length: ``nth`` counts from 0 within shard and length.
    """
    sizes = pieces.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("size"))
    sizes = staged(sizes, "lengths")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("size").alias("n")).collect()}
    plan = best_fit_decreasing(counts, capacity)
    before = F.sum("size").over(W.partitionBy("length").orderBy("shard")) - F.col("size")
    shifts = sizes.select("length", "shard", before.alias("shift"))
    ranked = pieces.join(shifts, ["length", "shard"]).withColumn("rank", F.col("nth") + F.col("shift"))
    names = [c for c in pieces.columns if c not in ("shard", "nth")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*names).schema.fields)
    at_length, at_rank = names.index("length"), len(names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(at_length).to_numpy(zero_copy_only=False)
            ranks = batch.column(at_rank).to_numpy(zero_copy_only=False)
            bins, offsets = plan.place(lengths, ranks)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked.select(*names, "rank").mapInArrow(step, f"{kinds}, sequence_id bigint, offset bigint")


def default_tokenizer() -> tuple[str, str]:
    """A public vocabulary: the tokenizer's file and the same as merge ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    columns: dict | None = None,
) -> DataFrame:
    """Packed pieces: doc_id, piece, start, length, sequence_id, offset.

    With ``columns`` (name to expression over ``ids``) these are computed from the ids of each piece; by
    default the ids themselves come along.
    """
    path, ranks = (tokenizer_path, None) if tokenizer_path else default_tokenizer()
    pieces = staged(cut_pieces(docs, path, capacity, ranks_path=ranks), "pieces")
    extra = {"ids": F.col("ids")} if columns is None else columns
    chosen = pieces.select(
        "doc_id", "piece", "start", "length", *[c.alias(n) for n, c in extra.items()], "shard", "nth"
    )
    return assign(chosen, capacity)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack(docs, columns={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
