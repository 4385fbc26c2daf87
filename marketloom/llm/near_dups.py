"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

A document's set holds the distinct shingles of its words. Documents with equal sets form a class, and one
of a class stands for it. MinHash bands put classes into buckets. Within a bucket each class is compared
with the bucket's hub, a member chosen by hash, so that a class meets as many different hubs as it has bands
and no bucket is expanded into pairs. Buckets that still hold several components are then compared
in blocks inside tasks, only across components, and emit nothing but survivors; so no link is lost.

Verification of a candidate pair is sequential. A signature has one byte for each of ``BINS`` ranges of the
shingles' hashes: of the smallest hash there, or 0. Batches of bins are compared, and after each batch the pair is
dropped when a pair at the threshold would differ in so many bins with a probability below the chosen miss
probability's share of the batch. The bins seen are a sample of the union drawn without replacement, so that
probability is a hypergeometric tail; the posterior probability, under a uniform prior, that the similarity reaches the
threshold is smaller still. Survivors are verified exactly on the full sets.

Bands of 5 out of 160 hashes, 32 of them: a pair at similarity 0.8 shares none with probability 3e-6.

Defined cases: null or empty texts, and those without words, have an empty set and are linked with nothing; fewer words
than a shingle takes make one shingle of the whole sequence; rows with one doc_id are one document; rows
without doc_id are linked with nothing and kept; an empty table gives no rows; a group of any size has one
kept document, the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bloom import split_by_ids
from marketloom.llm.common import few, mix64, run_starts, staged, table, utf8, words_of
from marketloom.llm.graph import components

BANDS, ROWS = 32, 5
BINS = 512
BATCH = 64
MISS = 1e-6
#: Members of a bucket that a task compares with one another at once.
BLOCK = 1024

_SEEDS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR = (_SEEDS & np.uint64(0xFFFFFFFF)).astype(np.uint32)
_TIMES = ((_SEEDS >> np.uint64(32)).astype(np.uint32)) | np.uint32(1)


def shingles(data: bytes, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles of a text."""
    words = words_of(data.lower())
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    width = min(n, size)
    with np.errstate(over="ignore"):
        mixed = np.full(n - width + 1, width, dtype=np.uint64)
        for k in range(width):
            mixed = mix64(mixed + hashes[k : n - width + 1 + k] * np.uint64(2 * k + 3))
    return np.unique(mixed)


def minima(values: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    small = (values >> np.uint64(32)).astype(np.uint32)[:, None]
    out = np.empty(len(_XOR), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(_XOR), 32):
            step = max(1, (1 << 20) // 32)
            parts = [
                ((small[i : i + step] ^ _XOR[k : k + 32]) * _TIMES[k : k + 32]).min(axis=0)
                for i in range(0, len(small), step)
            ]
            out[k : k + 32] = parts[0] if len(parts) == 1 else np.min(parts, axis=0)
    return out


def sketch(values: np.ndarray) -> tuple[list[int], bytes]:
    """Bucket keys of the bands, and the signature of the sorted hashes."""
    banded = minima(values).reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + banded[:, k])
    bins = (values >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)
    first = np.flatnonzero(run_starts(bins))
    signature = np.zeros(BINS, dtype=np.uint8)
    signature[bins[first]] = np.maximum((values[first] >> np.uint64(40)) & np.uint64(0xFF), 1)
    return keys.view(np.int64).tolist(), signature.tobytes()


# ------------------------------------------------------------------ sequential Bayesian pruning


_LOG_FACTORIALS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 1024)))])


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """Of whole numbers; by Stirling's series beyond a table, with an error under 3e-12 and that of rounding."""
    x = np.maximum(n, 1024) + 1.0
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x)
    return np.where(n < 1024, _LOG_FACTORIALS[np.minimum(n, 1023)], far)


def _log_choose(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def log_tail(union: np.ndarray, differ: np.ndarray, seen: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Upper bound of the log probability of ``found`` or more differing ones among ``seen`` of a union with ``differ``.

    Up to the mean the bound is 1. Behind it, the terms of the hypergeometric tail fall off at least as fast as the
    first does to the second, so a geometric series is above the tail. Impossible numbers have probability 0.
    """
    possible = (seen <= union) & (found <= differ)
    union, seen = np.where(possible, union, 1), np.where(possible, seen, 0)
    differ, found = np.where(possible, differ, 0), np.where(possible, found, 0)
    far = found * union > seen * differ
    same = np.where(far, union - differ, 0)
    u, d, n, k = (np.where(far, x, 0) for x in (union, differ, seen, found))
    # Fewer differ than there must be only up to the mean, so the terms exist.
    first = _log_choose(d, k) + _log_choose(same, np.minimum(n - k, same)) - _log_choose(u, n)
    ratio = (d - k) * (n - k) / np.maximum((k + 1.0) * (same - n + k + 1), 1)
    tail = np.where(far, first - np.log1p(-np.where(far, ratio, 0.0)), 0.0)
    return np.where(possible, np.minimum(tail, 0.0), -np.inf)


def survives(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, threshold: float, miss: float = MISS) -> np.ndarray:
    """Rows of two signature matrices that no batch rules out; ``sizes`` has the shingles of both sets together.

    A pair that reaches the threshold shares ``least`` shingles or more, so its union has ``sizes - least`` at
    most, of which all but ``least`` differ. Bins with a shingle of either set show as many of the union; a
    chance match only makes a pair look more alike. All looks together miss with probability ``miss`` at most.
    """
    least = np.ceil(threshold * sizes / (1 + threshold) - 1e-6).astype(np.int64)
    union = sizes.astype(np.int64) - least
    differ = union - least
    limit = np.log(miss / (BINS // BATCH))
    alive = np.arange(len(left))
    seen = np.zeros(len(left), dtype=np.int64)
    found = np.zeros(len(left), dtype=np.int64)
    for start in range(0, BINS, BATCH):
        one, other = left[alive, start : start + BATCH], right[alive, start : start + BATCH]
        seen[alive] += ((one | other) != 0).sum(axis=1)
        found[alive] += (one != other).sum(axis=1)
        alive = alive[log_tail(union[alive], differ[alive], seen[alive], found[alive]) >= limit]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, BINS)


def _pruned(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) that the signatures don't rule out."""
    left = signatures.select(F.col("rep").alias("a"), F.col("signature").alias("left"), F.col("n_shingles").alias("n"))
    right = signatures.select(F.col("rep").alias("b"), F.col("signature").alias("right"), F.col("n_shingles").alias("k"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(4).to_numpy(zero_copy_only=False)
            alive = survives(_matrix(batch.column(2)), _matrix(batch.column(3)), sizes, threshold)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(alive)) for c in batch.columns[:2]], names=["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", F.col("n") + F.col("k"))
    return joined.mapInArrow(step, "a bigint, b bigint")


def _in_blocks(crowded: DataFrame, threshold: float) -> DataFrame:
    """Pairs across components inside crowded buckets that the signatures don't rule out.

    Rows: group (bucket and pair of blocks), side (0 or 1; equal for a block with itself), rep, component,
    signature, n_shingles, keys. A group has two blocks at most and is compared inside one task. A pair that
    shares several buckets is looked at in the first of them only.
    """

    def compare(key: int, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        left = [r for r in rows if r[0] == 0]
        right = [r for r in rows if r[0] == 1] or left
        if not left:
            return
        own = right is left
        signatures = np.frombuffer(b"".join(r[3] for r in right), dtype=np.uint8).reshape(-1, BINS)
        parts = np.array([r[2] for r in right], dtype=np.int64)
        sizes = np.array([r[4] for r in right], dtype=np.int64)
        keys = np.stack([r[5] for r in right])
        for i, (_, rep, component, signature, size, mine) in enumerate(left):
            others = np.flatnonzero(parts != component)
            others = others[others > i] if own else others
            # Sets whose sizes differ too much can't reach the threshold.
            fits = np.minimum(sizes[others], size) >= threshold * np.maximum(sizes[others], size) - 1e-9
            others = others[fits]
            shared = keys[others] == mine
            others = others[mine[shared.argmax(axis=1)] == key]
            repeated = np.broadcast_to(np.frombuffer(signature, dtype=np.uint8), (len(others), BINS))
            for k in others[survives(repeated, signatures[others], sizes[others] + size, threshold)]:
                yield min(rep, right[k][1]), max(rep, right[k][1])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def done() -> list[tuple[int, int]]:
            return list(compare(int(group.partition(":")[0]), held)) if held else []

        for batch in batches:
            found: list[tuple[int, int]] = []
            keys = batch.column(6).flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
            columns = (c.to_pylist() for c in batch.columns[:6])
            for k, (mine, *row) in enumerate(zip(*columns, strict=True)):
                if mine != group:
                    found += done()
                    group, held = mine, []
                held.append((*row, keys[k]))
            yield _pairs(found)
        yield _pairs(done())

    def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], names=["a", "b"]
        )

    ordered = crowded.select("group", "side", "rep", "component", "signature", "n_shingles", "keys").repartition("group")
    return ordered.sortWithinPartitions("group", "side", "rep").mapInArrow(step, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    one, other = (pairs.select(F.col(c).alias("doc_id")).distinct() for c in ("a", "b"))
    ends = staged(one.unionByName(other).distinct(), "ends", few(pairs.sparkSession))
    likely, _ = split_by_ids(docs, ends, ends.count())

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(data, size).tobytes() for data in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "shingles"])

    needed = likely.join(ends, "doc_id", "left_semi").select("doc_id", "data")
    needed = staged(needed.mapInArrow(sets, "doc_id bigint, shingles binary"), "sets")
    left = needed.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = needed.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                one, other = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.sort(np.concatenate([one, other]))
                shared = int((both[1:] == both[:-1]).sum())
                if shared and 100 * shared >= percent * (len(one) + len(other) - shared):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(good, pa.int64())) for c in batch.columns[:2]], names=["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(step, "a bigint, b bigint")


# ------------------------------------------------------------------ the operator


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, a row for each row of ``docs``."""
    threshold, tasks = percent / 100, few(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("data"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys, signatures = [], [], [], []
            for data in batch.column(1).to_pylist():
                values = shingles(data, words)
                sizes.append(len(values))
                if len(values):
                    banded, signature = sketch(values)
                    digests.append(xxhash.xxh3_128_digest(values.tobytes()))
                    keys.append(banded)
                    signatures.append(signature)
                else:
                    digests.append(None)
                    keys.append(None)
                    signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "keys", "signature"],
            )

    schema = "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>, signature binary"
    sketches = staged(source.mapInArrow(step, schema), "sketches")
    named = sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(named.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes", tasks)
    firsts = named.join(classes.withColumnRenamed("digest", "_digest"), (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("_digest")))
    firsts = firsts.dropDuplicates(["digest"]).select("rep", "keys", "signature", "n_shingles")
    firsts = staged(firsts, "firsts", tasks)
    signatures = firsts.select("rep", "signature", "n_shingles", "keys").dropDuplicates(["rep"])

    banded = firsts.select("rep", F.explode("keys").alias("key"))
    hubs = (
        banded.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("key", "rep").alias("h"), "rep")).alias("hub"))
        .where("n > 1")
        .select("key", "n", F.col("hub.rep").alias("hub"))
    )
    hubs = staged(hubs, "hubs", tasks)
    # Only rows in buckets of two or more go on; a class with several texts can meet itself.
    crowded = staged(banded.join(hubs, "key").select("key", "n", "rep", "hub"), "crowded", tasks)
    stars = crowded.where("rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    survivors = staged(_pruned(stars.distinct(), signatures, threshold), "star_survivors", tasks)
    links = staged(_confirmed(survivors, source, words, percent), "star_links", tasks)

    rest = _rest(crowded.where("n > 2").select("key", "rep"), components(links), signatures)
    survivors = staged(_in_blocks(rest, threshold), "block_survivors", tasks)
    more = staged(_confirmed(survivors, source, words, percent), "block_links", tasks)
    # Rows that share an id are one document, whatever their texts are.
    same = named.join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    twice = same.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("c")).where("b <> c")
    labels = components(links.unionByName(more).unionByName(twice.select(F.col("b").alias("a"), F.col("c").alias("b"))))

    found = (
        sketches.select("doc_id", "n_shingles", "digest")
        .join(classes, "digest", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    )
    component = F.coalesce("component", "rep", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _rest(crowded: DataFrame, labels: DataFrame, signatures: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt out in pairs of blocks.

    Members of a bucket's largest component are never compared with one another, so they come in blocks
    that meet only the blocks of the others.
    """
    labelled = crowded.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    sizes = staged(labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size")), "bucket_parts", few(crowded.sparkSession))
    buckets = (
        sizes.groupBy("key")
        .agg(
            F.max(F.struct("size", "component")).alias("major"),
            F.sum("size").alias("members"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .select(
            "key",
            F.col("major.component").alias("major"),
            F.ceil((F.col("members") - F.col("major.size")) / BLOCK).cast("int").alias("minor_blocks"),
            F.ceil(F.col("major.size") / BLOCK).cast("int").alias("major_blocks"),
        )
    )
    buckets = staged(buckets, "buckets", few(crowded.sparkSession))
    dealt = labelled.join(buckets, "key").join(signatures, "rep")
    h = F.xxhash64("rep")
    minor = dealt.where("component <> major").withColumn("block", F.pmod(h, F.col("minor_blocks")).cast("int"))
    major = dealt.where("component = major").withColumn("block", F.pmod(h, F.col("major_blocks")).cast("int"))
    cells = ["rep", "component", "signature", "n_shingles", "keys"]
    every_minor = F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1))
    every_major = F.explode(F.sequence(F.lit(0), F.col("major_blocks") - 1))
    small, large = F.least("block", "other"), F.greatest("block", "other")
    within = minor.withColumn("other", every_minor).select(
        F.struct("key", F.lit(0).alias("kind"), small.alias("i"), large.alias("j")).alias("group"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        *cells,
    )
    left = minor.withColumn("other", every_major).select(
        F.struct("key", F.lit(1).alias("kind"), F.col("block").alias("i"), F.col("other").alias("j")).alias("group"),
        F.lit(0).alias("side"),
        *cells,
    )
    right = major.withColumn("other", every_minor).select(
        F.struct("key", F.lit(1).alias("kind"), F.col("other").alias("i"), F.col("block").alias("j")).alias("group"),
        F.lit(1).alias("side"),
        *cells,
    )
    parts = within.unionByName(left).unionByName(right)
    return parts.withColumn("group", F.concat_ws(":", "group.key", "group.kind", "group.i", "group.j"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, words=4, percent=80)


#: All pairs that share a shingle, and the links followed from every document.
OP3_SQL = r"""
WITH RECURSIVE
words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
cells AS (SELECT rep, unnest(s) AS shingle FROM classes),
pairs AS (
    SELECT a.rep AS a, b.rep AS b, count(*) AS shared
    FROM cells a JOIN cells b ON a.shingle = b.shingle AND a.rep < b.rep GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT rep AS node, rep AS seen FROM classes
    UNION
    SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen),
labels AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
       coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN labels ON labels.node = classes.rep
"""
