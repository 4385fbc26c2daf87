"""Blocked Bloom filters of bounded size, to leave rows out before a shuffle. They never lose a key.

A key is an unsigned 64-bit hash; it has one block of 256 bits and one bit in each of eight 32-bit lanes.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 8
#: 8 MB of lanes at most; with more keys the filter passes more rows and results stay the same.
MOST_BLOCKS = 1 << 18


def blocks_for(keys: int, bits_per_key: int = 16) -> int:
    """A power of two of blocks for this many keys."""
    wanted = max(1, keys * bits_per_key // 256)
    return min(MOST_BLOCKS, 1 << (wanted - 1).bit_length())


def _block(key: Column, blocks: int) -> Column:
    return key.bitwiseAND(F.lit(blocks - 1))


def _bit(key: Column, lane: int) -> Column:
    return F.shiftrightunsigned(key, 20 + 5 * lane).bitwiseAND(F.lit(31)).cast("int")


def filter_rows(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block`` and eight lanes for the blocks that have a key."""
    column = F.col(key).cast("bigint")
    lanes = keys.select(_block(column, blocks).alias("block"), *[_bit(column, i).alias(f"b{i}") for i in range(LANES)])
    return lanes.groupBy("block").agg(*[F.expr(f"bit_or(shiftleft(1L, b{i}))").alias(f"lane{i}") for i in range(LANES)])


def may_hold(rows: DataFrame, key: Column, filtered: DataFrame, blocks: int, flag: str = "_may") -> DataFrame:
    """The rows with a boolean ``flag``: whether the filter may hold the key. The filter's size is bounded.

    The rows may have columns of any other name.
    """
    own = uuid.uuid4().hex
    lanes = [f"lane{i}_{own}" for i in range(LANES)]
    small = filtered.select(F.col("block").alias(f"block_{own}"), *[F.col(f"lane{i}").alias(n) for i, n in enumerate(lanes)])
    keyed = rows.withColumn(f"key_{own}", key)
    joined = keyed.join(F.broadcast(small), _block(F.col(f"key_{own}"), blocks) == F.col(f"block_{own}"), "left")
    may = F.col(f"block_{own}").isNotNull()
    for i, lane in enumerate(lanes):
        bit = _bit(F.col(f"key_{own}"), i)
        may = may & (F.call_function("shiftrightunsigned", F.col(lane), bit).bitwiseAND(F.lit(1)) == 1)
    return joined.withColumn(flag, F.coalesce(may, F.lit(False))).drop(f"key_{own}", f"block_{own}", *lanes)


def split_by_ids(docs: DataFrame, ids: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Documents whose ``doc_id`` may be among ``ids`` and those for which it certainly is not."""
    blocks = blocks_for(count)
    filtered = filter_rows(ids.select(F.xxhash64("doc_id").alias("key")), "key", blocks)
    flag = f"may_{uuid.uuid4().hex}"
    marked = may_hold(docs, F.xxhash64("doc_id"), filtered, blocks, flag)
    return marked.where(flag).drop(flag), marked.where(~F.col(flag)).drop(flag)


class Filter:
    """The lanes as an array, for steps in Python."""

    def __init__(self, filtered: DataFrame, blocks: int) -> None:
        table = filtered.toArrow()
        self.blocks = blocks
        self.lanes = np.zeros((blocks, LANES), dtype=np.uint32)
        at = table.column("block").to_numpy()
        for i in range(LANES):
            self.lanes[at, i] = table.column(f"lane{i}").to_numpy().astype(np.uint32)

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys the filter may hold."""
        alive = np.ones(len(keys), dtype=bool)
        block = (keys & np.uint64(self.blocks - 1)).astype(np.int64)
        for i in range(LANES):
            bit = ((keys >> np.uint64(20 + 5 * i)) & np.uint64(31)).astype(np.uint32)
            alive &= ((self.lanes[block, i] >> bit) & np.uint32(1)).astype(bool)
        return alive
