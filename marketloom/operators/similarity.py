"""Cosine neighbours of customers and of products, and recommendations from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.columns import first_word, ratio
from marketloom.functions.keys import dense_ids, ordered_ids
from marketloom.operators.marts import product_info
from marketloom.operators.reports import top_k_per_key
from marketloom.session import brief_shuffles, drop_folders, new_folder, passing, single_rows, stored
from marketloom.sources.schemas import MONEY

# Similarities are ranked and reported at this precision, so summation order cannot reorder ties.
DIGITS = 9
#: Cells in a block of ids; a task meets two blocks.
BLOCK_CELLS = 1 << 16
#: Products of two cells that a task adds up at once; a row has as many as a block has cells at most.
POSTINGS = 1 << 20
#: Similarities of a block that a task holds at once.
HELD = 1 << 22
#: Cells of a block as a matrix, and how many of its products take as long as one that is looked up.
DENSE_CELLS = 1 << 25
DENSE_GAIN = 100
#: Blocks are larger where there would be more of them, up to so many cells.
BLOCKS = 24
MOST_CELLS = 1 << 21
#: Blocks over so few features are matrices, of so many entries at most; so many of them meet a block in a task.
MOST_DENSE = 256
DENSE_BLOCK = 1 << 23
MET_AT_ONCE = 8
#: Rows of a block that meet another one together, rows and columns that are bounded together, and features of such bounds.
TILE, BOX, RUN, LEADS = 256, 8, 16, 8
#: Runs that are bounded together first.
WIDE = 8
#: Columns that are multiplied at once, and those around its own place from which a row takes its first neighbours.
CHUNK, SEED = 2048, 1024
#: Pairs that are summed up exactly at once, and how many times k a row may have in a chunk before only its best are looked at.
EXACT, MANY = 1 << 14, 32
#: Weights as single precision numbers are at least this, so that products don't vanish.
LEAST_WEIGHT = 1e-15
#: Pairs of ids that the join on features lists for each cell at most.
PAIRS_PER_CELL = 64
#: Entries of arrays that are sent to their ids at once, and the most parts of the ids that meet one after the other.
LISTED_AT_ONCE = 1 << 24
MOST_PARTS = 64
#: Bounds are sums in another order than the similarities, which are rounded.
SLACK = 4 * 10.0**-DIGITS
MOST_TASKS = 20_000
#: Parts in which blocks are numbered.
PARTS = 1024


def interactions(customer_sales: DataFrame) -> DataFrame:
    """Spend per customer and product: the non-zero cells of the customer-product matrix."""
    return (
        customer_sales.where(F.col("Description").isNotNull())
        .groupBy("CustomerID", "StockCode")
        .agg(F.sum("TotalAmount").alias("Spend"))
    )


def spend_matrix(customer_sales: DataFrame) -> DataFrame:
    """The interactions, stored: scaling, similarity and recommendations all read them."""
    return stored(interactions(customer_sales))


def minmax_scaled(inter: DataFrame) -> DataFrame:
    """Each product's spend scaled to 0..1 over all customers; a customer without it has spend 0.

    The smallest value is therefore 0 unless every customer bought the product. A product with one
    value only scales to 0.
    """
    customers = inter.agg(F.count_distinct("CustomerID")).scalar()
    spend = F.col("Spend").cast("double")
    ranges = inter.groupBy(F.col("StockCode").alias("_code")).agg(
        F.max(spend).alias("_high"), F.min(spend).alias("_min"), F.count(F.lit(1)).alias("_buyers")
    )
    low = F.when(F.col("_buyers") < customers, F.lit(0.0)).otherwise(F.col("_min"))
    scaled = F.coalesce(F.try_divide(spend - low, F.col("_high") - low), F.lit(0.0))
    return inter.join(ranges, F.col("StockCode") == F.col("_code")).select(
        "CustomerID", "StockCode", scaled.alias("Scaled")
    )


def unit_vectors(cells: DataFrame, entity: str, feature: str, weight: str) -> DataFrame:
    """Cells as (id, f, w) with every id's weights scaled to length 1; zero cells are dropped."""
    cells = cells.where(F.col(weight) != 0)
    norms = cells.groupBy(F.col(entity).alias("_id")).agg(
        F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias("_norm")
    )
    return cells.join(norms, F.col(entity) == F.col("_id")).select(
        F.col(entity).alias("id"), F.col(feature).alias("f"), (F.col(weight) / F.col("_norm")).alias("w")
    )


class _Side:
    """The ids of a block in order, with their cells by id and by feature. Features are numbers."""

    def __init__(self, block: pa.Table) -> None:
        names = block["id"].to_numpy()
        order = np.argsort(names)
        self.names = names[order]
        floors = block["floor"].to_numpy()[order]
        # Similarities from which on an id wants a neighbour; nobody's is under the smallest number over 0.
        self.wanted = np.where(np.isinf(floors), np.inf, np.maximum(floors - SLACK, np.nextafter(0.0, 1.0)))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        lengths = pc.list_value_length(block["fs"]).to_numpy()
        who = np.repeat(place, lengths)
        features = pc.list_flatten(block["fs"]).to_numpy().astype(np.int64)
        weights = pc.list_flatten(block["ws"]).to_numpy()
        by_id, by_feature = np.lexsort((features, who)), np.lexsort((who, features))
        self.who, self.features, self.weights = who[by_id], features[by_id], weights[by_id]
        self.edges = np.searchsorted(self.who, np.arange(len(self.names) + 1))
        self.posting_feature, self.posting_id = features[by_feature], who[by_feature]
        self.posting_weight = weights[by_feature]

    def dense(self, shared: np.ndarray) -> np.ndarray:
        """The weights of the shared features as a matrix with a row for each id."""
        at = np.searchsorted(shared, self.features)
        known = at < len(shared)
        known[known] = shared[at[known]] == self.features[known]
        out = np.zeros((len(self.names), len(shared)))
        out[self.who[known], at[known]] = self.weights[known]
        return out

    def rows(self, other: _Side, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some of the chosen ids at a time, with their similarities to all ids of another side, 0 where no feature is shared."""
        low = np.searchsorted(other.posting_feature, self.features, side="left")
        sizes = np.searchsorted(other.posting_feature, self.features, side="right") - low
        wide, start = len(other.names), 0
        shared = np.intersect1d(self.features, other.features)
        cells = len(shared) * max(len(self.names), wide)
        if cells <= DENSE_CELLS and len(shared) * len(self.names) * wide <= DENSE_GAIN * sizes.sum():
            left, right = self.dense(shared), other.dense(shared).T
            step = max(1, HELD // wide)
            for start in range(0, len(chosen), step):
                ids = chosen[start : start + step]
                yield ids, left[ids] @ right
            return
        whole = np.concatenate([[0], np.cumsum(sizes)])
        work = np.cumsum(whole[self.edges[chosen + 1]] - whole[self.edges[chosen]])
        while start < len(chosen):
            done = work[start - 1] if start else 0
            upto = max(start + 1, int(np.searchsorted(work, done + POSTINGS, side="right")))
            ids = chosen[start : min(upto, start + max(1, HELD // wide))]
            start += len(ids)
            lengths = self.edges[ids + 1] - self.edges[ids]
            cell = np.repeat(self.edges[ids] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            size = sizes[cell]
            entry = np.repeat(low[cell] - np.cumsum(size) + size, size) + np.arange(size.sum())
            place = np.repeat(np.repeat(np.arange(len(ids)), lengths) * wide, size) + other.posting_id[entry]
            dots = np.bincount(place, np.repeat(self.weights[cell], size) * other.posting_weight[entry], len(ids) * wide)
            yield ids, dots.reshape(len(ids), wide)


def _best(dots: np.ndarray, wanted: np.ndarray, k: int, axis: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest of every row (axis 1) or column (axis 0) that are wanted there, equal ones by place: own, other, value."""
    hit = dots >= np.expand_dims(wanted, axis)
    if dots.shape[axis] > k and np.count_nonzero(hit) > 8 * k * len(wanted):
        kth = np.partition(dots, -k, axis=axis).take(-k, axis=axis)
        hit = dots >= np.expand_dims(np.maximum(wanted, kth - SLACK), axis)
    # Far quicker on flat flags than on rows of them.
    row, column = np.divmod(np.flatnonzero(hit.ravel()), dots.shape[1])
    value = np.round(dots[row, column], DIGITS)
    own, other = (row, column) if axis else (column, row)
    order = np.lexsort((other, -value, own))
    own, other, value = own[order], other[order], value[order]
    first = np.arange(len(own)) - np.searchsorted(own, own) < k
    return own[first], other[first], value[first]


def _pair_best(left: _Side, right: _Side, k: int, same: bool) -> pa.Table:
    """The k most similar ids of the other block for every id that asks, ties by id; each pair is computed once.

    A few rows are held at a time; ids on the right get their best of these rows. The final cut is to k over all.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    both = not same and bool(np.isfinite(right.wanted).any())
    # Where nobody on the right asks, only rows that ask are wanted.
    chosen = np.arange(len(left.names)) if both else np.flatnonzero(np.isfinite(left.wanted))
    for ids, dots in left.rows(right, chosen):
        if same:
            dots[np.arange(len(ids)), ids] = -1.0
        own, other, value = _best(dots, left.wanted[ids], k, 1)
        out.append((left.names[ids[own]], right.names[other], value))
        if both:
            own, other, value = _best(dots, right.wanted, k, 0)
            out.append((right.names[own], left.names[ids[other]], value))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
    kinds = {"id": pa.int32(), "neighbour": pa.int32(), "similarity": pa.float64()}
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


_FOUND = "id int, neighbour int, similarity double"


def _met(blocks: DataFrame, k: int, pairs: int) -> DataFrame:
    """What the pairs of blocks (i, j) find. ``blocks``: i, j, side (0 or 1), id, fs, ws, floor; i = j has side 0 alone.

    ``floor`` is the similarity that a neighbour must have, infinite for ids that don't ask. A pair is little data and much
    work, so the pairs are dealt over as many tasks as there are, not by their bytes.
    """

    def step(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        second = pc.equal(block["side"], 1)
        left = _Side(block.filter(pc.invert(second)))
        same = block["i"][0].as_py() == block["j"][0].as_py()
        return _pair_best(left, left if same else _Side(block.filter(second)), k, same)

    return blocks.repartition(max(1, min(pairs, MOST_TASKS)), "i", "j").groupBy("i", "j").applyInArrow(step, _FOUND)


class _Dense:
    """The ids of a block as rows of a matrix, in the order of their heaviest features and these weights.

    Single precision columns serve to find pairs, double precision rows for their sums. Of many ids with the same cells only the
    first k + 1 are columns (``places``): ties go by id, so the others are nobody's neighbours.
    """

    def __init__(self, block: dict, width: int, k: int) -> None:
        self.k = k
        self.names = np.frombuffer(block["names"], dtype=np.int32)
        self.floors = np.frombuffer(block["floors"], dtype=np.float64)
        lengths = np.frombuffer(block["lengths"], dtype=np.int32)
        features, weights = np.frombuffer(block["fs"], dtype=np.uint8), np.frombuffer(block["ws"], dtype=np.float64)
        at = np.repeat(np.arange(len(lengths)) * width, lengths) + features
        self.rows = np.bincount(at, weights, len(lengths) * width).reshape(len(lengths), width)
        self.longest = float(np.sqrt(np.einsum("ij,ij->i", self.rows, self.rows).max(initial=0.0)))
        self.near = np.full((len(self.names), k), -1, dtype=np.int32)
        self.sims = np.full((len(self.names), k), -1.0)

    def single(self, rows: np.ndarray) -> np.ndarray:
        out = rows.astype(np.float32)
        np.maximum(out, np.float32(LEAST_WEIGHT), out=out, where=rows > 0)
        return out

    def places(self) -> np.ndarray:
        """The rows that can be neighbours: of more than ``MANY`` times k equal ones, which are in the order of their ids, the first."""
        n = len(self.names)
        starts = np.flatnonzero(np.concatenate([[True], (self.rows[1:] != self.rows[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, n))
        return np.flatnonzero((np.arange(n) - np.repeat(starts, sizes) <= self.k) | np.repeat(sizes <= MANY * self.k, sizes))

    def as_columns(self, place: np.ndarray) -> None:
        """What others need to meet these ids: columns, and bounds over runs of them."""
        self.place = place
        rows = self.rows if len(place) == len(self.rows) else self.rows[place]
        self.columns = np.ascontiguousarray(self.single(rows).T)
        edges, wide = np.arange(0, len(place), RUN), np.arange(0, -(-len(place) // RUN), WIDE)
        squares = np.maximum.reduceat(np.einsum("ij,ij->j", self.columns, self.columns), edges)
        highs, lows = np.maximum.reduceat(self.columns, edges, axis=1), np.minimum.reduceat(self.columns, edges, axis=1)
        self.fine = highs, lows, squares
        self.coarse = np.maximum.reduceat(highs, wide, axis=1), np.minimum.reduceat(lows, wide, axis=1), np.maximum.reduceat(squares, wide)

    def open_runs(self, rows: np.ndarray, least: np.ndarray, slack: float) -> np.ndarray:
        """The runs of columns that may hold a similarity of ``least`` to one of the rows.

        Over the features with most weight in the rows, the largest weights of a box of rows and of a run are multiplied; over the
        others, a similarity is at most the product of lengths.
        """
        leads = np.argsort(-np.einsum("ij,ij->j", rows, rows), kind="stable")[:LEADS]
        chosen = rows[:, leads]
        rest = np.sqrt(np.maximum(0.0, np.einsum("ij,ij->i", rows, rows) - np.einsum("ij,ij->i", chosen, chosen)) + slack)
        edges = np.arange(0, len(rows), BOX)
        boxes = np.maximum.reduceat(np.column_stack([chosen, rest, -least]), edges, axis=0).astype(np.float32)
        some = np.arange(self.coarse[0].shape[1])
        some = some[_bounds(boxes, leads, *self.coarse, slack) >= -slack]
        some = (some[:, None] * WIDE + np.arange(WIDE)).ravel()
        some = some[some < self.fine[0].shape[1]]
        highs, lows, squares = self.fine
        kept = _bounds(boxes, np.ix_(leads, some), highs, lows, squares[some], slack) >= -slack if len(some) else []
        return some[kept]

    def meet(self, other: _Dense) -> None:
        """Take what is closer among the columns of a block; a block meets itself first, which gives each row a floor."""
        n, width, k = len(self.names), self.rows.shape[1], self.k
        # Twice what a sum of products in single precision can be off.
        slack = (width + 16) * 2.0**-23 * max(1.0, self.longest * other.longest)
        for start in range(0, n, TILE):
            rows = self.rows[start : start + TILE]
            single, here = self.single(rows), np.arange(start, start + len(rows))
            own = np.searchsorted(other.place, here) if self is other else None
            kth = np.maximum(self.floors[here], self.sims[here, k - 1])
            least = np.maximum(kth - SLACK - slack, np.nextafter(0.0, 1.0))
            if own is not None:
                low = max(0, int(own[0]) - SEED // 2)
                dots = self._products(single, other, np.arange(low, min(len(other.place), low + SEED)), here, own)
                least = np.maximum(least, _kth(dots, k) - SLACK - 2 * slack)
            runs = other.open_runs(rows, least, slack)
            for first in range(0, len(runs), CHUNK // RUN):
                some = runs[first : first + CHUNK // RUN]
                at = (some[:, None] * RUN + np.arange(RUN)).ravel()
                at = at[at < len(other.place)]
                dots = self._products(single, other, at, here, own)
                asks = np.flatnonzero(dots.max(axis=1, initial=0.0) >= least)
                if not len(asks):
                    continue
                dots = dots[asks]
                hit = dots >= least[asks, None]
                if np.count_nonzero(hit) > MANY * k * len(asks):
                    hit &= dots >= (_kth(dots, k) - SLACK - 2 * slack)[:, None]
                row, column = np.nonzero(hit)
                row = asks[row]
                for part in range(0, len(row), EXACT):
                    r, c = row[part : part + EXACT], other.place[at[column[part : part + EXACT]]]
                    sums = np.round(np.einsum("ij,ij->i", rows[r], other.rows[c]), DIGITS)
                    wanted = sums >= self.floors[here[r]] - SLACK
                    self._take(here[r[wanted]], other.names[c[wanted]], sums[wanted])
                least = np.maximum(least, self.sims[here, k - 1] - SLACK - slack)

    @staticmethod
    def _products(single: np.ndarray, other: _Dense, at: np.ndarray, here: np.ndarray, own: np.ndarray | None) -> np.ndarray:
        """Products of the rows and some columns, in order; 0 for a row and itself."""
        whole = len(at) and at[-1] - at[0] + 1 == len(at)
        columns = other.columns[:, at[0] : at[-1] + 1] if whole else other.columns[:, at]
        dots = single @ columns
        if own is not None and len(at):
            spot = np.searchsorted(at, own)
            known = np.flatnonzero(spot < len(at))
            known = known[(at[spot[known]] == own[known]) & (other.place[at[spot[known]]] == here[known])]
            dots[known, spot[known]] = 0.0
        return dots

    def _take(self, row: np.ndarray, name: np.ndarray, value: np.ndarray) -> None:
        """Keep the k best of every row, ties by id."""
        rows, k = np.unique(row), self.k
        own = np.concatenate([np.repeat(rows, k), row])
        near, sims = np.concatenate([self.near[rows].ravel(), name]), np.concatenate([self.sims[rows].ravel(), value])
        order = np.lexsort((near, -sims, own))
        own = own[order]
        order = order[np.arange(len(own)) - np.searchsorted(own, own) < k]
        self.near[rows], self.sims[rows] = near[order].reshape(-1, k), sims[order].reshape(-1, k)

    def found(self) -> pa.Table:
        row, column = np.nonzero(self.near >= 0)
        columns = self.names[row], self.near[row, column], self.sims[row, column]
        return pa.table(dict(zip(("id", "neighbour", "similarity"), columns, strict=True)))


def _bounds(boxes: np.ndarray, at: np.ndarray | tuple, highs: np.ndarray, lows: np.ndarray, squares: np.ndarray, slack: float) -> np.ndarray:
    """By how much a run's similarity to one of the boxes may pass what is asked for, at most."""
    lows = lows[at]
    rest = np.sqrt(np.maximum(0.0, squares - np.einsum("ij,ij->j", lows, lows)) + np.float32(slack))
    return (boxes @ np.concatenate([highs[at], [rest, np.ones_like(rest)]])).max(axis=0)


def _kth(dots: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, less than any where there are fewer."""
    return np.partition(dots, -k, axis=1)[:, -k].astype(np.float64) if dots.shape[1] >= k else np.full(len(dots), -1.0)


_BLOCK = {"block": "bigint", "names": "binary", "lengths": "binary", "fs": "binary", "ws": "binary", "floors": "binary", "places": "binary"}


def _dense_block(table: pa.Table, block: int, width: int, k: int) -> tuple[dict, _Dense]:
    """The rows (id, fs, ws, floor; cells by falling weight) as one row of bytes, once they have met each other."""
    lengths = pc.list_value_length(table["fs"]).to_numpy().astype(np.int32)
    starts, cells = np.cumsum(lengths) - lengths, lengths.sum()
    features, weights = pc.list_flatten(table["fs"]).to_numpy(), pc.list_flatten(table["ws"]).to_numpy()
    names = table["id"].to_numpy().astype(np.int32)
    leads = [np.where(lengths > i, features[np.minimum(starts + i, cells - 1)], -1) for i in (2, 1, 0)]
    tops = [np.where(lengths > i, weights[np.minimum(starts + i, cells - 1)], 0.0) for i in (2, 1, 0)]
    # The last key counts first: the heaviest features, their weights, all cells, ids.
    order = np.lexsort([names, np.add.reduceat(weights * (features + 1), starts), *tops, *leads])
    cell = np.repeat(starts[order] - np.cumsum(lengths[order]) + lengths[order], lengths[order]) + np.arange(cells)
    row = {
        "block": block,
        "names": names[order].tobytes(),
        "lengths": lengths[order].tobytes(),
        "fs": features[cell].astype(np.uint8).tobytes(),
        "ws": weights[cell].astype(np.float64).tobytes(),
        "floors": table["floor"].to_numpy()[order].astype(np.float64).tobytes(),
    }
    dense = _Dense(row, width, k)
    place = dense.places()
    dense.as_columns(place)
    dense.meet(dense)
    row["places"] = place.astype(np.int32).tobytes()
    row["floors"] = np.maximum(dense.floors, dense.sims[:, k - 1]).tobytes()
    return row, dense


def in_dense_blocks(vectors: DataFrame, width: int, k: int, blocks: int) -> DataFrame:
    """The closest ids by features that number ``width`` at most: id, neighbour, similarity. ``vectors``: id, fs, ws, floor.

    A block is one row of bytes. It first meets itself, which gives each id a k-th similarity to beat, and then each other block,
    with the closest ids carried from one to the next. Nothing is sent but the blocks, twice: a pair of blocks is read by the
    task that runs it. Bounds over runs of ids leave out what can't be closer; where they leave out nothing, this is the work
    of all pairs.
    """
    most = max(1, DENSE_BLOCK // width)
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in _BLOCK.items()])
    packed = {**_BLOCK, "found": "binary"}

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [batch for batch in batches if batch.num_rows]
        table = pa.Table.from_batches(rows) if rows else None
        for number, start in enumerate(range(0, table.num_rows if rows else 0, most)):
            part = table.slice(start, most).combine_chunks()
            row, dense = _dense_block(part, (TaskContext.get().partitionId() << 20) + number, width, k)
            row["found"] = _as_bytes(dense.found())
            yield pa.RecordBatch.from_pylist([row], schema=fields.append(pa.field("found", pa.binary())))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in batch["found"]:
                yield from pa.ipc.open_stream(found.as_buffer()).read_all().to_batches()

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != at:
                    if block is not None:
                        yield from block.found().to_batches()
                    at, block = row["block"], _Dense(row, width, k)
                other = _Dense({name: row[f"_{name}"] for name in _BLOCK}, width, k)
                other.as_columns(np.frombuffer(row["_places"], dtype=np.int32))
                block.meet(other)
        if block is not None:
            yield from block.found().to_batches()

    lead = F.slice("fs", 1, 3)
    dealt = vectors.repartitionByRange(blocks, lead, "ws", "id")
    homes = stored(dealt.mapInArrow(home, ", ".join(f"{name} {kind}" for name, kind in packed.items())))
    with single_rows(homes.sparkSession):
        found = stored(homes.select("found").mapInArrow(spelled, _FOUND))
        count = homes.count()
        if count < 2:
            return found
        ours = homes.select(*_BLOCK).repartitionByRange(count, "block")
        theirs = homes.select(*[F.col(name).alias(f"_{name}") for name in _BLOCK])
        theirs = theirs.repartitionByRange(-(-count // MET_AT_ONCE), "_block")
        # A side is never sent as a whole to every task, and each of its rows meets all rows of a part of the other side in turn.
        pairs = ours.join(theirs.hint("shuffle_replicate_nl"), F.col("block") != F.col("_block"))
        return found.unionByName(stored(pairs.mapInArrow(others, _FOUND)))


def _as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def in_blocks(cells: DataFrame, block_cells: int) -> DataFrame:
    """Ids with their block: about ``block_cells`` cells each, ids with the same heaviest feature together.

    Ids with more cells than that have no block. Places are summed up inside ``PARTS`` parts, so only the parts' sizes pass
    through one task.
    """
    sizes = cells.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.max_by("f", F.struct("w", "f")).alias("_lead"))
    sizes = stored(sizes.withColumn("_part", F.pmod(F.xxhash64("_lead"), F.lit(PARTS))))
    light = sizes.where(F.col("_n") <= block_cells)
    parts = light.groupBy("_part").agg(F.sum("_n").alias("_size"))
    starts = parts.select("_part", (F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).alias("_start"))
    inside = F.sum("_n").over(W.partitionBy("_part").orderBy("_lead", "id"))
    block = F.floor((F.col("_start") + F.col("_inside") - F.col("_n")) / F.lit(block_cells)).cast("bigint")
    placed = light.withColumn("_inside", inside).join(starts, "_part").select("id", block.alias("block"))
    return placed.unionByName(sizes.where(F.col("_n") > block_cells).select("id", F.lit(None).cast("bigint").alias("block")))


def heavy_pairs(cells: DataFrame) -> DataFrame:
    """Similarities of the ids without a block with all ids, both ways. Each has more cells than a block, so they are few."""
    heavy = cells.where(F.col("block").isNull()).select(F.col("id").alias("other"), "f", F.col("w").alias("_v"))
    pairs = cells.join(heavy, "f").where(F.col("block").isNotNull() | (F.col("id") < F.col("other")))
    sims = pairs.groupBy("id", "other").agg(F.round(F.sum(F.col("w") * F.col("_v")), DIGITS).alias("similarity"))
    both = F.array(F.struct("id", F.col("other").alias("neighbour")), F.struct(F.col("other").alias("id"), F.col("id").alias("neighbour")))
    return sims.select(F.explode(both).alias("p"), "similarity").select("p.id", "p.neighbour", "similarity")


def asking(cells: DataFrame, floors: DataFrame) -> DataFrame:
    """The blocks that each id still has to meet: those that may hold a closer id than its k-th so far.

    The largest weight of every feature in a block bounds its similarities. An id's features are taken from the most
    spread one on; as long as their largest weights anywhere stay under the k-th similarity together, blocks that share
    only those can't matter, and are not even listed. Over the other features the block's own weights are added.
    ``cells``: id, f, w, block; ``floors``: id and floor, the k-th similarity (0 with fewer).
    """
    tops = cells.groupBy("block", "f").agg(F.max("w").alias("_top"))
    # One row for each feature, with an entry for each block.
    spread = tops.groupBy("f").agg(
        F.max("_top").alias("_most"), F.collect_list(F.struct(F.col("block").alias("other"), "_top")).alias("_tops")
    )
    bounded = cells.join(spread, "f").join(floors, "id").withColumn("_up", F.col("w") * F.col("_most"))
    order = W.partitionBy("id").orderBy(F.size("_tops").desc(), "f")
    bounded = bounded.withColumn("_sum", F.sum("_up").over(order.rowsBetween(W.unboundedPreceding, 0)))
    skipped = F.col("_sum") < F.col("floor") - SLACK
    rest = F.coalesce(F.max(F.when(skipped, F.col("_sum"))).over(W.partitionBy("id")), F.lit(0.0))
    kept = bounded.withColumn("_rest", rest).where(~skipped).select("id", "block", "floor", "_rest", "w", F.explode("_tops").alias("_at"))
    bound = (
        kept.where(F.col("block") != F.col("_at.other"))
        .groupBy("id", "block", F.col("_at.other").alias("other"), "floor", "_rest")
        .agg(F.sum(F.col("w") * F.col("_at._top")).alias("_bound"))
    )
    return bound.where(F.col("_bound") + F.col("_rest") >= F.col("floor") - SLACK).select("id", "block", "other")


def block_pairs(asks: DataFrame) -> DataFrame:
    """The pairs of blocks (i < j) that somebody asks for."""
    return asks.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).distinct()


def joined_on(cells: DataFrame, pairs_per_cell: int) -> int:
    """The most ids that a feature may have to be joined on: those features list so many pairs of ids for each cell at most."""
    sizes = cells.groupBy("f").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("_features"))
    # One row for each number of ids, of which there are at most the square root of twice the cells.
    listed = F.sum(F.col("_features") * F.col("n") * F.col("n")).over(W.orderBy("n"))
    total = F.sum(F.col("_features") * F.col("n")).over(W.partitionBy())
    kept = sizes.select("n", listed.alias("_listed"), total.alias("_total")).where(F.col("_listed") <= F.col("_total") * pairs_per_cell)
    with brief_shuffles(cells.sparkSession):
        return kept.agg(F.max("n").alias("n")).first()["n"] or 0


def feature_lists(light: DataFrame) -> DataFrame:
    """The ids of every feature that more than one id has, as one array ``at``; ``light``: id, f, w and maybe rest."""
    entry = F.struct(*[c for c in light.columns if c != "f"])
    lists = light.where(F.col("f").isNotNull()).groupBy("f").agg(F.collect_list(entry).alias("at"))
    return lists.select("at").where(F.size("at") > 1)


def listed_sums(lists: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """id, other and the sum over their shared features for the ids of one part, from ``feature_lists``.

    An id gets the array of each of its features once, ids and weights apart, which is far less than rows of pairs. Sums stay
    partitioned by id, so the closest are chosen without a further shuffle.
    """
    fields = lists.schema["at"].dataType.elementType.names
    own = F.col("at")
    if parts > 1:
        own = F.filter("at", lambda e: F.pmod(F.xxhash64(e["id"]), F.lit(parts)) == part)
    arrays = [F.col(f"at.{c}").alias(f"_{c}") for c in fields]
    sent = lists.select(F.explode(own).alias("me"), *arrays).select("me.*", *[f"_{c}" for c in fields]).repartition("id")
    pairs = sent.select(*fields, F.explode(F.arrays_zip(*[f"_{c}" for c in fields])).alias("p")).where(F.col("id") != F.col("p._id"))
    sums = [F.sum(F.col("w") * F.col("p._w")).alias("dot")]
    if "rest" in fields:
        sums.append(F.max(F.col("rest") * F.col("p._rest")).alias("rest"))
    return pairs.groupBy("id", F.col("p._id").alias("other")).agg(*sums)


def joined_pairs(light: DataFrame) -> DataFrame:
    """id, other and the sum over their shared features, for all pairs of ids that share one; ``light``: id, f, w, rest.

    ``rest`` is the length of the weights an id has besides; a pair's is the product, the most that can come to its sum.
    """
    return listed_sums(feature_lists(light))


def parts_for(listed: int) -> int:
    """In how many parts so many entries of arrays are sent."""
    return max(1, min(MOST_PARTS, -(-listed // LISTED_AT_ONCE)))


def in_parts(lists: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` makes of the ``listed_sums``, stored; for one part of the ids after the other where they list much.

    The arrays sent to the ids are the most that ``nearest`` keeps on disk; those of a part go before the next is sent.
    """
    listed = lists.agg(F.sum(F.size("at").cast("bigint") * F.size("at"))).first()[0] or 0
    parts = parts_for(listed)
    found = [stored(build(listed_sums(lists, part, parts))) for part in range(parts)]
    return reduce(DataFrame.unionByName, found)


def kth_largest(column: str, k: int) -> Column:
    """The k-th largest value of a column over the rows of an id, 0 with fewer."""
    place = W.partitionBy("id").orderBy(F.col(column).desc()).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return F.coalesce(F.nth_value(column, k).over(place), F.lit(0.0))


def completed(pairs: DataFrame, hot: DataFrame, k: int) -> DataFrame:
    """Similarities over all features of the joined pairs that can be among an id's k closest."""
    floor = kth_largest("dot", k)
    left = stored(pairs.withColumn("_floor", floor).where(F.col("dot") + F.col("rest") >= F.col("_floor") - SLACK))
    theirs = hot.select(F.col("id").alias("other"), "f", F.col("w").alias("v"))
    more = left.where(F.col("rest") > 0).select("id", "other").join(hot, "id").join(theirs, ["other", "f"])
    parts = left.select("id", "other", "dot").unionByName(more.select("id", "other", (F.col("w") * F.col("v")).alias("dot")))
    sums = parts.groupBy("id", F.col("other").alias("neighbour"))
    return sums.agg(F.round(F.sum("dot"), DIGITS).alias("similarity"))


def in_block_pairs(cells: DataFrame, floors: DataFrame, k: int, block_cells: int) -> DataFrame:
    """The closest ids by these cells: id, neighbour, similarity. ``floors``: id and the k-th similarity known so far.

    Ids lie in blocks of about ``block_cells`` cells, more where that would be over ``BLOCKS`` blocks, up to ``MOST_CELLS``:
    each block is sent to every other one that asks for it. Every block first meets itself, which gives each id a k-th
    similarity to beat. Bounds over blocks then tell which other blocks an id has to meet; pairs of blocks that nobody asks
    for are not run, the others once, in a task of two blocks at most. Ids with more cells than a block meet the others
    by a join on features. Where features are few, blocks are matrices (``in_dense_blocks``).
    """
    count, least = cells.count(), block_cells
    numbers = stored(dense_ids(cells, "f", "_f"))
    width = numbers.count()
    if 0 < width <= MOST_DENSE:
        heaviest = F.sort_array(F.collect_list(F.struct("w", "_f")), asc=False)
        vectors = cells.join(numbers, "f").groupBy("id").agg(heaviest.alias("_cells"))
        vectors = vectors.select("id", F.col("_cells._f").alias("fs"), F.col("_cells.w").alias("ws"))
        vectors = stored(vectors.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0))))
        blocks = max(min(BLOCKS, count // least), count // MOST_CELLS, vectors.count() * width // DENSE_BLOCK) + 1
        return in_dense_blocks(vectors, width, k, blocks)
    block_cells = max(block_cells, min(MOST_CELLS, count // BLOCKS))
    blocks = stored(in_blocks(cells, block_cells))
    placed = stored(cells.join(blocks, "id"))
    homed = placed.where(F.col("block").isNotNull())
    vectors = homed.join(numbers, "f").groupBy("id", "block").agg(F.collect_list(F.struct("_f", "w")).alias("_cells"))
    vectors = vectors.select("id", "block", F.col("_cells._f").alias("fs"), F.col("_cells.w").alias("ws"))
    vectors = stored(vectors.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0))))
    same = vectors.select(F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"), "id", "fs", "ws", "floor")
    last = blocks.agg(F.max("block").alias("last")).first()["last"]
    found = inside = stored(_met(same, k, 1 if last is None else last + 1))
    if not blocks.where(F.col("block").isNull()).isEmpty():
        found = found.unionByName(heavy_pairs(placed))
    if last:
        # What an id has found in its own block is k rows at most.
        kth = F.when(F.count(F.lit(1)) >= k, F.sort_array(F.collect_list("similarity"), asc=False)[k - 1])
        met = inside.groupBy("id").agg(kth.alias("_kth"))
        floor = F.greatest("floor", F.coalesce("_kth", F.lit(0.0)))
        floors = stored(vectors.join(met, "id", "left").select("id", "block", floor.alias("floor")))
        asks = stored(asking(homed, floors.select("id", "floor")))
        pairs = stored(block_pairs(asks))
        ends = pairs.select("i", "j", F.explode(F.array("i", "j")).alias("block"))
        other = F.when(F.col("block") == F.col("i"), F.col("j")).otherwise(F.col("i"))
        ids = floors.join(ends, "block").withColumn("other", other)
        ids = ids.join(asks.select("id", "other", F.lit(True).alias("asks")), ["id", "other"], "left")
        side = (F.col("block") == F.col("j")).cast("int").alias("side")
        floor = F.when(F.col("asks"), F.col("floor")).otherwise(F.lit(float("inf"))).alias("floor")
        ids = ids.select("i", "j", side, "id", floor).join(vectors.select("id", "fs", "ws"), "id")
        found = found.unionByName(_met(ids.select("i", "j", "side", "id", "fs", "ws", "floor"), k, pairs.count()))
    return found


def nearest(
    unit: DataFrame,
    k: int = 5,
    block_cells: int = BLOCK_CELLS,
    pairs_per_cell: int = PAIRS_PER_CELL,
    folders: Sequence[str] = (),
) -> DataFrame:
    """The k most similar other ids per id that share a feature with it: id, neighbour, similarity, rank.

    Exact, with ties by id; weights are positive. Features of few ids list pairs of ids by a join, about ``pairs_per_cell``
    for each cell at most, so that work grows with the cells. Pairs that a join lists get their whole similarity, but those
    that can't be among the k closest by a bound on the rest. Ids that share only features of many ids meet in blocks, where
    a pair's similarity over these features is at most its whole one: an id's k-th similarity so far rules out blocks.
    ``folders`` are read by ``unit`` alone and go as soon as its cells are stored.
    """
    spark, texts, numbered, listed = unit.sparkSession, *(new_folder(unit.sparkSession) for _ in range(3))
    cells = unit.select(F.col("id").cast("string").alias("id"), F.col("f").cast("string").alias("f"), F.col("w").cast("double").alias("w"))
    cells = stored(cells.where(F.col("id").isNotNull()), texts)
    drop_folders(spark, list(folders))
    # Numbers in the order of the ids: far less to send, and ties go the same way.
    names = stored(ordered_ids(cells.select("id").distinct(), "id", "_number"))
    cells = stored(cells.join(names, "id").select(F.col("_number").alias("id"), "f", "w"), numbered)
    drop_folders(spark, [texts])
    most = joined_on(cells, pairs_per_cell)
    wide = stored(cells.groupBy("f").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("f"))
    order = [F.col("similarity").desc(), F.col("neighbour")]

    def best(found: DataFrame) -> DataFrame:
        return top_k_per_key(found, ["id"], order, k, "rank").select("id", "neighbour", "similarity", "rank")

    def similar(pairs: DataFrame) -> DataFrame:
        return pairs.select("id", F.col("other").alias("neighbour"), F.round("dot", DIGITS).alias("similarity"))

    if wide.isEmpty():
        lists = stored(feature_lists(cells), listed)
        drop_folders(spark, [numbered])
        closest = in_parts(lists, lambda pairs: best(similar(pairs)))
    else:
        hot = stored(cells.join(wide, "f", "left_semi").select("id", "f", "w"))
        rest = hot.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("rest"))
        light = cells.join(wide, "f", "left_anti").join(rest, "id", "left").withColumn("rest", F.coalesce("rest", F.lit(0.0)))
        joined = in_parts(stored(feature_lists(light), listed), lambda pairs: completed(pairs, hot, k))
        floors = joined.select("id", kth_largest("similarity", k).alias("floor")).distinct()
        found = joined.unionByName(in_block_pairs(hot, floors, k, block_cells))
        closest = best(found.groupBy("id", "neighbour").agg(F.max("similarity").alias("similarity")))
        closest = stored(closest)
    drop_folders(spark, [numbered, listed])
    theirs = names.select(F.col("_number").alias("neighbour"), F.col("id").alias("_neighbour"))
    named = closest.join(theirs, "neighbour").join(names.withColumnRenamed("id", "_id"), F.col("id") == F.col("_number"))
    return named.select(F.col("_id").alias("id"), F.col("_neighbour").alias("neighbour"), "similarity", "rank")


def _nearest_by(inter: DataFrame, entity: str, feature: str, k: int, block_cells: int) -> DataFrame:
    """Neighbours by cosine of scaled spend. Scaled cells are stored, so the shuffles that scale them go before lengths are."""
    scaled = new_folder(inter.sparkSession)
    unit = unit_vectors(stored(minmax_scaled(inter), scaled), entity, feature, "Scaled")
    return nearest(unit, k, block_cells, folders=[scaled])


def customer_similarity(inter: DataFrame, neighbours: int = 5, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The most similar other customers by cosine of scaled spend."""
    return _nearest_by(inter, "CustomerID", "StockCode", neighbours, block_cells).select(
        F.col("id").alias("CustomerID"),
        F.col("neighbour").alias("Neighbour"),
        F.col("similarity").alias("Similarity"),
        F.col("rank").alias("Rank"),
    )


def product_similarity(inter: DataFrame, neighbours: int = 5, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The most similar other products by cosine of the scaled spend of their buyers."""
    return _nearest_by(inter, "StockCode", "CustomerID", neighbours, block_cells).select(
        F.col("id").alias("StockCode"),
        F.col("neighbour").alias("Neighbour"),
        F.col("similarity").alias("Similarity"),
        F.col("rank").alias("Rank"),
    )


def _contribution() -> Column:
    """Similarity times spend. Both have few digits as decimals, so sums are exact in any order."""
    return F.col("Similarity").cast(T.DecimalType(DIGITS + 1, DIGITS)) * F.col("Spend").cast(MONEY)


def baskets_of(inter: DataFrame) -> DataFrame:
    """What each customer bought, as one array ``at`` of products and spend; stored, so its shuffle goes before it is sent on."""
    bought = inter.select("CustomerID", "StockCode", F.col("Spend").cast(MONEY).alias("Spend"))
    baskets = bought.groupBy("CustomerID").agg(F.collect_list(F.struct("StockCode", "Spend")).alias("_at"))
    return stored(baskets.select("CustomerID", F.col("_at.StockCode").alias("_codes"), F.col("_at.Spend").alias("_spends")))


def unseen_in(near: DataFrame, baskets: DataFrame, whose: Column | None = None) -> DataFrame:
    """Products of a customer's neighbours that the customer has not bought, with their score, from ``baskets_of``.

    ``whose`` says of which customers; ``near`` has only these.

    What a neighbour bought reaches a customer as arrays, as does what the customer bought; they are then summed up where they
    are, and products that the customer has are left out, without a shuffle of single rows.
    """
    theirs = near.select("CustomerID", F.col("Neighbour").alias("_from"), "Similarity").join(
        baskets.withColumnRenamed("CustomerID", "_from"), "_from"
    )
    theirs = theirs.select("CustomerID", "Similarity", "_codes", "_spends", F.lit(False).alias("_own"))
    nothing = [F.lit(None).cast("double").alias("Similarity"), "_codes", F.array().cast(T.ArrayType(MONEY)).alias("_spends")]
    own = baskets if whose is None else baskets.where(whose)
    own = own.select("CustomerID", *nothing, F.lit(True).alias("_own"))
    sent = theirs.unionByName(own).repartition("CustomerID")
    items = sent.select("CustomerID", "Similarity", "_own", F.explode(F.arrays_zip("_codes", "_spends")).alias("_item"))
    items = items.select("CustomerID", F.col("_item._codes").alias("StockCode"), "Similarity", F.col("_item._spends").alias("Spend"), "_own")
    scored = items.groupBy("CustomerID", "StockCode").agg(
        F.sum(_contribution()).alias("Score"), F.bool_and("_own").alias("_only"), F.bool_or("_own").alias("_has")
    )
    new = ~F.col("_only") & (~F.col("_has") | F.col("StockCode").isNull())
    return scored.where(new).select("CustomerID", "StockCode", "Score")


def unseen_in_parts(near: DataFrame, inter: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` makes of the unseen items; customers come in parts, as in ``in_parts``, and parts are stored."""
    baskets = baskets_of(inter)
    sizes = inter.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("CustomerID").alias("customers")).first()
    # An entry holds a text and a decimal, twice what ``nearest`` sends.
    parts = parts_for(2 * near.count() * sizes["n"] // max(1, sizes["customers"]))
    if parts == 1:
        return build(unseen_in(near, baskets))
    mine = F.pmod(F.xxhash64("CustomerID"), F.lit(parts))
    each = (unseen_in(near.where(mine == part), baskets, mine == part) for part in range(parts))
    return reduce(DataFrame.unionByName, [stored(build(items)) for items in each])


def unseen_items(near: DataFrame, inter: DataFrame) -> DataFrame:
    """Products of a customer's neighbours that the customer has not bought, with their score."""
    return unseen_in_parts(stored(near), inter, lambda items: items)


def best_unseen(near: DataFrame, inter: DataFrame, k: int = 5) -> DataFrame:
    """The k best products per customer among those its neighbours bought and it did not."""
    order = [F.col("Score").desc(), F.col("StockCode")]
    return unseen_in_parts(near, inter, lambda items: top_k_per_key(items, ["CustomerID"], order, k))


def neighbour_recommendations(
    customer_sales: DataFrame, neighbours: int = 5, k: int = 5, block_cells: int = BLOCK_CELLS
) -> DataFrame:
    """The best unseen products per customer, weighted by similarity and the neighbours' spend."""
    spark = customer_sales.sparkSession
    chosen, closest = new_folder(spark), new_folder(spark)
    # Each step's intermediate rows go before the next one's are written.
    with passing(spark):
        inter = spend_matrix(customer_sales)
        with passing(spark):
            near = stored(customer_similarity(inter, neighbours, block_cells), closest)
        best = stored(best_unseen(near, inter, k), chosen)
    drop_folders(spark, [closest])
    info = stored(product_info(customer_sales).select("StockCode", "Description", "AveragePrice"))
    return best.join(info, "StockCode").select(
        "CustomerID",
        F.col("StockCode").alias("ProductStockCode"),
        F.col("Description").alias("ProductDescription"),
        F.col("Score").alias("RecommendationScore"),
        "Rank",
        "AveragePrice",
        first_word("Description").alias("ProductCategory"),
    )


def with_descriptions(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Recommendations with one product name each; products without a name stay."""
    names = products.groupBy(F.col("StockCode").alias("_code")).agg(
        F.min("Description").alias("Description")
    )
    return recs.join(names, F.col("ProductStockCode") == F.col("_code"), "left").drop("_code")


def recommendation_summary(recs: DataFrame, customer_sales: DataFrame) -> DataFrame:
    """Reach, volume, scores and the percent of customers with a recommendation."""
    # One row, stored: in the query on the recommendations the sales would be shuffled beside what these are made of.
    customers = stored(customer_sales.agg(F.count_distinct("CustomerID").alias("n"))).select("n").scalar()
    return recs.agg(
        F.count_distinct("CustomerID").alias("customers_with_recs"),
        F.count(F.lit(1)).alias("total_recommendations"),
        F.count_distinct("ProductStockCode").alias("unique_products"),
        F.avg("RecommendationScore").alias("avg_score"),
        F.max("RecommendationScore").alias("max_score"),
    ).withColumn("coverage_pct", ratio("customers_with_recs", customers) * 100)


def high_value_recommendations(
    recs: DataFrame, customer_sales: DataFrame, factor: float = 1.5
) -> DataFrame:
    """Recommended products priced above a multiple of the mean line price."""
    mean_price = customer_sales.where(F.col("Description").isNotNull()).agg(
        ratio(F.sum("UnitPrice"), F.count("UnitPrice"))
    ).scalar()
    return recs.where(F.col("AveragePrice") > mean_price * factor)


def shared_products(near: DataFrame, inter: DataFrame) -> DataFrame:
    """How many products each customer has in common with each of its neighbours."""
    cells = inter.select("CustomerID", "StockCode")
    return (
        near.select("CustomerID", "Neighbour")
        .join(cells, "CustomerID")
        .join(cells.withColumnRenamed("CustomerID", "Neighbour"), ["Neighbour", "StockCode"])
        .groupBy("CustomerID", "Neighbour")
        .agg(F.count(F.lit(1)).alias("SharedProducts"))
    )


def new_products(near: DataFrame, inter: DataFrame) -> DataFrame:
    """Set difference: what the neighbours bought minus what the customer bought."""
    cells = inter.select("CustomerID", "StockCode")
    theirs = near.select("CustomerID", "Neighbour").join(
        cells.withColumnRenamed("CustomerID", "Neighbour"), "Neighbour"
    )
    return theirs.select("CustomerID", "StockCode").subtract(cells)
