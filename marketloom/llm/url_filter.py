"""URL rules by a blocked Bloom filter and an exact join.

Every listed entry (host, path) is one key. A URL is probed with the keys of all entries that could
fit it: its host and parent domains, each with the path prefixes of the listed lengths. The blocked
Bloom filter (one 256-bit block per key, one bit in each of eight lanes) passes possible hits, and an
exact join on the key removes its false positives. Everything is a DataFrame expression.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule; a URL with
several fitting entries takes the longest (host and path together, then the key in order); an entry listed
twice with both verdicts blocks; an empty list leaves every URL to the default; repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import table

LANES = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rules as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rest_of(url: Column) -> Column:
    """What follows the first ``://``, empty without one."""
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit of 32 in each lane, from a second hash of the key."""
    mixed = F.xxhash64(F.lit("lanes"), key)
    return [F.shiftrightunsigned(mixed, 5 * lane).bitwiseAND(F.lit(31)).cast("int") for lane in range(LANES)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """Blocks with at least one key: ``block`` and the lanes as 32-bit words."""
    bits = _bits(F.col("key"))
    return (
        keys.select(
            _block(F.col("key"), blocks).alias("block"),
            *[F.expr("1L").alias(f"one{i}") for i in range(LANES)],
            *[b.alias(f"bit{i}") for i, b in enumerate(bits)],
        )
        .groupBy("block")
        .agg(*[F.expr(f"bit_or(shiftleft(one{i}, bit{i}))").alias(f"lane{i}") for i in range(LANES)])
    )


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    url: str = "url",
    default: str = "allow",
    bits_per_key: int = 16,
    max_filter_bytes: int = 32 << 20,
) -> DataFrame:
    """Pages with ``host``, ``path``, ``rule`` (the entry, or null) and ``verdict``.

    ``listed`` has host, path and verdict (allow or block); null entries are left out. The filter takes
    ``bits_per_key`` bits for each entry and ``max_filter_bytes`` at most; beyond that it passes more false
    positives to the exact join and results stay the same. Columns of ``pages`` with the names of the
    results are replaced.
    """
    entries = (
        listed.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("_verdict"))
        .select(
            F.concat("host", "path").alias("key"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("path").alias("chars"),
            "_verdict",
        )
    )
    known = entries.agg(F.count("key").alias("n"), F.collect_set(F.struct("labels", "chars")).alias("shapes"))
    known = known.first()
    blocks = max(1, min(known["n"] * bits_per_key, max_filter_bytes * 8) // (32 * LANES))
    filter_blocks = bloom_blocks(entries.select("key"), blocks)
    if blocks * LANES * 8 <= 2 * max_filter_bytes:
        filter_blocks = F.broadcast(filter_blocks)

    address = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    distinct = address.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    # Only shapes that are listed: so many last labels of the host, so many first characters of the path.
    shapes = sorted((s["labels"], s["chars"]) for s in known["shapes"])
    probes = [
        F.when(
            (F.size(labels) >= n) & (F.length("path") >= chars),
            F.concat(F.concat_ws(".", F.slice(labels, -n, n)), F.substring("path", 1, chars)),
        )
        for n, chars in shapes
    ] or [F.lit(None).cast("string")]
    probed = distinct.withColumn("key", F.explode(F.array_compact(F.array(*probes))))
    bits = _bits(F.col("key"))
    lanes_hit = [F.expr(f"shiftright(lane{i}, _bit{i}) & 1L = 1L") for i in range(LANES)]
    possible = (
        probed.withColumn("block", _block(F.col("key"), blocks))
        .withColumns({f"_bit{i}": b for i, b in enumerate(bits)})
        .join(filter_blocks, "block")
    )
    for hit in lanes_hit:
        possible = possible.where(hit)
    best = (
        possible.select("host", "path", "key")
        .join(entries.select("key", "_verdict"), "key")
        .groupBy(F.col("host").alias("_host"), F.col("path").alias("_path"))
        .agg(F.max(F.struct(F.length("key").alias("length"), "key", "_verdict")).alias("_best"))
    )
    found = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return (
        address.join(best, found, "left")
        .withColumns(
            {
                "rule": F.col("_best.key"),
                "verdict": F.coalesce(F.col("_best._verdict"), F.lit(default)),
            }
        )
        .drop("_host", "_path", "_best")
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = """
WITH rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
address AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM rest),
rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
       arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(rule_verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM address LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""
