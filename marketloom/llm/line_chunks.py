"""Content-defined line chunks: repeated runs of two or more lines.

A rolling hash over the hashes of the lines with a word chooses where a chunk begins. It forgets all but the last two
lines, so texts that share a run of lines have the same chunks in it from its second line on, wherever it begins and
whatever surrounds it. A chunk ends with the line that begins the next one, so every pair of neighbouring lines lies in one
chunk. Chunks that occur more than once in the corpus are found by hash; the first (smallest doc_id, then position)
stays and later ones go after a comparison of their bytes with the first's.

These chunks leave the ends of a run and runs without a boundary in place. What they leave is therefore chunked
anew with every line as a boundary: its pairs of lines, with the blank lines between them, are treated in the same
way. A run of lines that occurs again is a chain of such pairs, so all repeated runs are found and each goes as a
whole. A line that goes stays where it occurs first.

In a row of equal lines the first two are a pair, and every further line is a pair with the line before it that takes
only itself along: "a a a" keeps "a a". Blank lines go where the lines on both sides went, or the text ends.

Texts reach the chunks' owners by one join of documents that have a repeated chunk; a bounded Bloom filter of their
ids leaves the others out.

Defined cases: null or empty texts have no chunk and stay as they are; texts of one line stay; rows with one
doc_id are one document, in which equal chunks at the same place are the same occurrence; rows without doc_id
stay as they are; line ends of what is kept stay, and a text can become empty; further columns of any name go through.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bloom import split_by_ids
from marketloom.llm.common import staged, table, utf8


#: One line in so many begins a chunk: first about every fourth, then every line. Powers of two.
DIVISORS = (4, 1)


def boundaries(lines: list[bytes], divisor: int) -> list[bool]:
    """Which lines begin a chunk: those at which the rolling hash is a multiple of the divisor.

    Each line doubles the hash, so of the lines before it only the last log2(divisor) - 1 still count.
    """
    roll, out = 0, []
    for line in lines:
        roll = (2 * roll + xxhash.xxh3_64_intdigest(line)) % divisor
        out.append(roll == 0)
    return out


def chunk_ranges(lines: list[bytes]) -> list[tuple[int, int, int]]:
    """First line, line after the last one, and first line that goes, of every pair."""
    full = [i for i, line in enumerate(lines) if line.strip()]
    out, before = [], None
    for i, j in zip(full, full[1:], strict=False):
        # Again the pair before, which shares a line with it.
        again = before is not None and lines[before : i + 1] == lines[i : j + 1]
        out.append((i, j + 1, i + 1 if again else i))
        before = i
    return out


def line_chunks(data: bytes, divisor: int, gone: set[int]) -> list[tuple[int, int, bytes]]:
    """First pair, pair after the last one, and bytes of every chunk of pairs that are not gone."""
    lines = data.split(b"\n")
    pairs = chunk_ranges(lines)
    if divisor == 1:
        return [(k, k + 1, b"\n".join(lines[a:b])) for k, (a, b, _) in enumerate(pairs) if k not in gone]
    begins = boundaries([lines[a] for a, _, _ in pairs], divisor)
    starts = [k for k, begin in enumerate(begins) if begin or k == 0]
    ends = [*starts[1:], len(pairs)]
    return [(k, m, b"\n".join(lines[pairs[k][0] : pairs[m - 1][1]])) for k, m in zip(starts, ends, strict=False) if m > k]


def repeatable_chunks(data: bytes) -> list[tuple[int, bytes]]:
    """Number and bytes of the pairs of lines with a word."""
    return [(k, content) for k, _, content in line_chunks(data, 1, set())]


def later_pairs(data: bytes, divisor: int, gone: set[int], later: list[dict]) -> set[int]:
    """The pairs of chunks that equal an earlier first occurrence byte by byte."""
    first = {c["content"]: c["own"] for c in later}
    return {p for k, m, content in line_chunks(data, divisor, gone) if first.get(content, k) != k for p in range(k, m)}


def without_chunks(data: bytes, drop: set[int]) -> tuple[bytes, int, int]:
    """The text without these pairs, the number of its lines and of those removed."""
    lines = data.split(b"\n")
    gone = bytearray(len(lines))
    for k, (_, b, own) in enumerate(chunk_ranges(lines)):
        if k in drop:
            gone[own:b] = b"\1" * (b - own)
    if drop:
        last, went = -1, True
        for i in [*(i for i, line in enumerate(lines) if line.strip()), len(lines)]:
            goes = i == len(lines) or bool(gone[i])
            if went and goes:
                gone[last + 1 : i] = b"\1" * (i - last - 1)
            last, went = i, goes
    kept = [line for line, g in zip(lines, gone, strict=True) if not g]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _halves(digests: list[bytes]) -> list[pa.Array]:
    """128-bit hashes as two columns of numbers."""
    halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
    return [pa.array(halves[:, 0]), pa.array(halves[:, 1])]


def repeated_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """doc_id, own and content of the chunks that occur earlier too; ``docs`` has doc_id, data and gone pairs.

    ``own`` is the first pair of the chunk's first occurrence where the document itself has that, else -1.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, times = [], [], []
            for doc, data, gone in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                counts = Counter(xxhash.xxh3_128_digest(content) for _, _, content in line_chunks(data, divisor, set(gone)))
                ids += [doc] * len(counts)
                digests += counts.keys()
                times += counts.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *_halves(digests), pa.array(times, pa.int64())], names=["doc_id", "h", "g", "times"]
            )

    known = docs.where("doc_id IS NOT NULL").select("doc_id", "data", "gone")
    found = staged(known.mapInArrow(hashed, "doc_id bigint, h bigint, g bigint, times bigint"), "chunks", codec="zstd")
    groups = found.groupBy("h", "g").agg(F.min("doc_id").alias("d"), F.sum("times").alias("n")).where("n > 1")

    # The bytes of the first occurrences.
    owners = groups.groupBy(F.col("d").alias("doc_id")).agg(F.collect_list(F.struct("h", "g")).alias("wanted"))
    owners = staged(owners, "owners")
    likely, _ = split_by_ids(known, owners.select("doc_id"), owners.count())

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, digests, out = [], [], [], []
            for doc, data, gone, wanted in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                chosen = set(np.array([(w["h"], w["g"]) for w in wanted], dtype=np.int64).view("V16").ravel().tolist())
                for k, _, content in line_chunks(data, divisor, set(gone)):
                    digest = xxhash.xxh3_128_digest(content)
                    if digest in chosen:
                        ids.append(doc)
                        numbers.append(k)
                        digests.append(digest)
                        out.append(content)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *_halves(digests), pa.array(numbers, pa.int32()), pa.array(out, pa.binary())],
                names=["d", "h", "g", "k", "content"],
            )

    firsts = likely.join(owners, "doc_id").select("doc_id", "data", "gone", "wanted")
    firsts = firsts.mapInArrow(contents, "d bigint, h bigint, g bigint, k int, content binary").groupBy("h", "g")
    firsts = firsts.agg(F.min("d").alias("d"), F.min(F.struct("k", "content")).alias("first"), F.max("k").alias("last"))
    firsts = firsts.select(
        F.col("h").alias("_h"), F.col("g").alias("_g"), "d", F.col("first.k").alias("k"), "last", F.col("first.content").alias("content")
    )
    firsts = staged(firsts, "firsts", codec="zstd")
    joined = found.join(firsts, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g"))).where("doc_id <> d OR k <> last")
    return joined.select("doc_id", F.when(F.col("doc_id") == F.col("d"), F.col("k")).otherwise(F.lit(-1)).alias("own"), "content")


def _with_later(docs: DataFrame, text: str, gone: str, divisor: int) -> DataFrame:
    """The documents, and last the chunks that occur earlier as an array of own and content."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8(F.col(f"`{text}`")).alias("data"), F.col(gone).alias("gone"))
    mark = uuid.uuid4().hex
    per_doc = repeated_chunks(source, divisor).groupBy(F.col("doc_id").alias(f"id_{mark}"))
    per_doc = staged(per_doc.agg(F.collect_list(F.struct("own", "content")).alias(f"later_{mark}")), "later_chunks", codec="zstd")
    likely, rest = split_by_ids(docs, per_doc.select(F.col(f"id_{mark}").alias("doc_id")), per_doc.count())
    none = F.array().cast("array<struct<own:int,content:binary>>")
    joined = likely.join(per_doc, F.col("doc_id") == F.col(f"id_{mark}"), "left").drop(f"id_{mark}")
    joined = joined.withColumn(f"later_{mark}", F.coalesce(f"later_{mark}", none))
    return joined.unionByName(rest.withColumn(f"later_{mark}", none))


def drop_repeated_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with cleaned ``text``, ``n_lines``, ``n_removed_lines`` and ``n_removed_chunks`` (pairs of lines)."""
    added = ["n_lines", "n_removed_lines", "n_removed_chunks"]
    kept = [c for c in docs.columns if c not in (text, *added)]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in kept]).schema.fields]
    gone = f"gone_{uuid.uuid4().hex}"
    whole, single = DIVISORS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for value, later in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 2).to_pylist(), strict=True):
                pairs.append(sorted(later_pairs((value or "").encode(), whole, set(), later)) if later else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(pairs, pa.list_(pa.int32()))], names=[*kept, text, gone])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, removed, dropped = [], [], [], []
            for value, pairs, later in zip(*(batch.column(len(kept) + i).to_pylist() for i in range(3)), strict=True):
                data = (value or "").encode()
                drop = set(pairs)
                if later:
                    drop |= later_pairs(data, single, drop, later)
                left, n, less = without_chunks(data, drop) if drop else (data, data.count(b"\n") + 1, 0)
                texts.append(None if value is None else left.decode())
                lines.append(n)
                removed.append(less)
                dropped.append(len(drop))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(texts, pa.string()), *[pa.array(c, pa.int64()) for c in (lines, removed, dropped)]],
                names=[*kept, text, *added],
            )

    rows = docs.select(*[f"`{c}`" for c in kept], f"`{text}`").withColumn(gone, F.array().cast("array<int>"))
    rows = _with_later(rows, text, gone, whole).mapInArrow(mark, ", ".join([*kinds, f"`{text}` string", f"{gone} array<int>"]))
    rows = _with_later(staged(rows, "whole_chunks", codec="zstd"), text, gone, single)
    schema = ", ".join([*kinds, f"`{text}` string", *[f"{a} bigint" for a in added]])
    return rows.mapInArrow(clean, schema).select(*[f"`{c}`" for c in docs.columns if c not in added], *added)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = drop_repeated_chunks(docs)
    return cleaned.select(
        "doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.sha2(utf8("text"), 256).alias("kept_sha256")
    )
