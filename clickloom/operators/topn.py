"""Top-N items per query vector.

Scores are matrix products inside tasks and never become rows. An item table
that is small enough (measured, not assumed) is broadcast and the queries stay
where they are. A larger one is hashed into blocks, as are the queries, and
every (query block, item block) pair is one group joined on the two block
numbers; a ranked window then merges the blocks. A block's vectors are bounded by
bytes, and both sides are cut so that the fewest rows are copied.

Items are scored in tiles of falling vector length. A score is at most the product of
both lengths (Cauchy-Schwarz), so a query whose n-th score is above that bound for
the next tile is finished, and a task stops when all its queries are.

A tile is scored in single precision, which is off by a known bound at most; what may be
among a query's best within that bound is scored again in double precision. Softmax sums
need every score in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator, Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.matrix import (
    BROADCAST_BYTES,
    Size,
    as_matrix,
    measure,
    small_items,
)

# Queries and excluded pairs of one group; items of one item block.
QUERIES_PER_BLOCK = 65_536
PAIRS_PER_BLOCK = 500_000
ITEMS_PER_BLOCK = 131_072
# Vectors of a block, in bytes; a worker holds a few copies of them.
BLOCK_BYTES = 16 * 1024 * 1024
MAX_GROUPS = 20_000
# Scores held at a time: a tile of queries by items. The second number of queries is for
# softmax sums, which pass over the tile several times and want it in the core's cache.
TILE_QUERIES, TILE_ITEMS = 512, 2_048
TILE_QUERIES_SUMMED = 128
# The first tile of items is smaller: it only has to fill the lists.
FIRST_TILE = 256
# Multiply-adds of one task at most, and the least that is worth a task of its own.
TASK_WORK, LEAST_WORK = 2.5e11, 1e9
BLOCKS_PER_TASK = 4
# Lengths whose products neither overflow nor vanish.
LEAST_LENGTH, MOST_LENGTH = 1e-100, 1e100
# Sums of exponentials up to this power need no common factor.
PLAIN_POWER = 300.0
# Numbers of vectors gathered at a time.
GATHERED = 2_097_152


@dataclass
class NormIndex:
    """Item vectors by falling length, in tiles; inside a tile by id."""

    matrix: np.ndarray
    place: np.ndarray  # each row's position among the sorted ids
    row: np.ndarray  # and the other way round
    starts: list[int]  # first rows of the tiles, and the end
    norms: list[float]  # the largest length in each tile
    plain: bool = False  # whether single precision finds the candidates

    @cached_property
    def near(self) -> np.ndarray:
        """The vectors over the largest length of their tile, in single precision."""
        found = np.empty(self.matrix.shape, dtype=np.float32)
        for start, stop, norm in zip(self.starts, self.starts[1:], self.norms):
            np.divide(
                self.matrix[start:stop], norm or 1.0, out=found[start:stop], casting="same_kind"
            )
        return found


def norm_index(matrix: np.ndarray, first: int | None = None) -> NormIndex:
    """Index the vectors of sorted ids; tiles grow from ``first`` to ``TILE_ITEMS`` rows."""
    count, size = len(matrix), min(first or FIRST_TILE, TILE_ITEMS)
    norms = np.linalg.norm(matrix, axis=1) if count else np.empty(0)
    order = np.argsort(-norms, kind="stable")
    starts = [0]
    while starts[-1] < count:
        starts.append(min(starts[-1] + size, count))
        size = min(2 * size, TILE_ITEMS)
    tiles = list(zip(starts[:-1], starts[1:], strict=True))
    largest = [float(norms[order[a]]) for a, _ in tiles]
    for a, b in tiles:
        order[a:b].sort()
    row = np.empty(count, dtype=np.int64)
    row[order] = np.arange(count)
    return NormIndex(matrix[order], order, row, starts, largest, _plain(norms))


def _plain(lengths: np.ndarray) -> bool:
    """Whether vectors of these lengths can be scaled to length 1."""
    return bool(np.all((lengths == 0) | ((lengths > LEAST_LENGTH) & (lengths < MOST_LENGTH))))


class Prepared:
    """An item table that is measured, and shipped if small, once for many calls of ``top_n``."""

    def __init__(
        self,
        items: DataFrame,
        item_col: str = "product_id",
        vector_col: str = "factor",
        broadcast_bytes: int = BROADCAST_BYTES,
    ):
        self.items = items.filter(F.col(vector_col).isNotNull())
        self.item_col, self.vector_col = item_col, vector_col
        self.size: Size = measure(self.items, item_col, vector_col)
        self.small = self.size.bytes <= broadcast_bytes
        self._shipped: Broadcast | None = None

    def shipped(self) -> Broadcast:
        """Sorted ids and their index, on every executor."""
        if self._shipped is None:
            ids, matrix = small_items(self.items, self.size, self.item_col, self.vector_col)
            context = self.items.sparkSession.sparkContext
            self._shipped = context.broadcast((ids, norm_index(matrix)))
        return self._shipped

    def close(self) -> None:
        """Free what was shipped; frames made with it can no longer be computed."""
        if self._shipped is not None:
            self._shipped.destroy()
            self._shipped = None


def top_n(
    queries: DataFrame,
    items: DataFrame,
    n: int = 10,
    exclude: DataFrame | None = None,
    query_col: str = "user_id",
    item_col: str = "product_id",
    vector_col: str = "factor",
    n_col: str | None = None,
    digits: int | None = None,
    temperature: float | None = None,
    lists: bool = False,
    n_queries: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    queries_per_block: int = QUERIES_PER_BLOCK,
    items_per_block: int = ITEMS_PER_BLOCK,
    prepared: Prepared | None = None,
    scored: Accumulator | None = None,
) -> DataFrame:
    """The ``n`` items with the largest dot product, for each query row.

    ``exclude`` holds (query, item) pairs to leave out. ``n_col`` names a column
    of ``queries`` with a limit per row. Ties go to the smaller item id;
    ``digits`` rounds scores before they are ranked. With ``temperature`` the
    softmax probability over all candidates is added. Query ids and item ids
    are unique; rows without a vector are left out. ``n_queries`` saves counting ``queries``
    where that is costly, ``prepared`` measuring and shipping ``items`` again. ``scored``
    is an accumulator that counts the (query, item) pairs whose score was computed.

    Returns query, item, ``score``, ``rank`` (and ``probability``), or with
    ``lists`` one row per query with the array ``recs``, best first.
    """
    if lists and temperature is not None:
        raise ValueError("lists carry no probability")
    spark = queries.sparkSession
    queries = queries.filter(F.col(vector_col).isNotNull())
    if prepared is None:
        prepared = Prepared(items, item_col, vector_col, broadcast_bytes)
    items, size, small = prepared.items, prepared.size, prepared.small
    limit = F.lit(n) if n_col is None else F.coalesce(F.col(n_col), F.lit(n))
    asked = queries.select(
        query_col,
        F.col(vector_col).cast("array<double>").alias("_vector"),
        limit.cast("int").alias("_limit"),
    )
    query_id, item_id = queries.schema[query_col].dataType, items.schema[item_col].dataType
    flat = T.StructType(
        [
            T.StructField(query_col, query_id),
            T.StructField(item_col, item_id),
            T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("_limit", T.IntegerType()),
            T.StructField("_mass", T.DoubleType()),
        ]
    )
    if size.rows == 0:
        best = spark.createDataFrame([], flat)
        return as_lists(best, query_col, item_col) if lists else _finish(best, query_col, None)
    if n_queries is None:
        n_queries = queries.count()
    cores = spark.sparkContext.defaultParallelism
    work = n_queries * size.rows * size.width
    tasks = max(math.ceil(work / TASK_WORK), min(cores, math.ceil(work / LEAST_WORK)))
    # One block of items: a task sees all of them and can build the lists itself.
    listed = lists and small
    schema = flat
    if listed:
        entry = T.StructType([flat["score"]])
        entry = T.StructType([T.StructField(item_col, item_id), *entry.fields])
        schema = T.StructType([flat[query_col], T.StructField("recs", T.ArrayType(entry))])
    score = partial(_score, query_col, item_col, digits, temperature, listed, scored)
    if small and exclude is None:
        shipped = prepared.shipped()
        if tasks > 1:
            asked = asked.repartition(tasks, query_col)
        best = asked.mapInArrow(_per_batch(score, shipped), schema)
        return best if listed else _finish(best, query_col, temperature)
    fits = max(1, BLOCK_BYTES // (8 * max(size.width, 1)))
    queries_per_block = min(queries_per_block, fits)
    item_blocks = 1 if small else math.ceil(size.rows / min(items_per_block, fits))
    # Blocks are hashed to partitions; several per task even out collisions.
    groups = tasks * BLOCKS_PER_TASK if tasks > 1 else 1
    query_blocks = math.ceil(n_queries / queries_per_block)
    if not small:
        # Queries are copied per item block and items per query block.
        even = math.sqrt(groups * size.rows / max(n_queries, 1))
        item_blocks = max(item_blocks, min(math.ceil(even), groups))
    n_pairs = 0
    if exclude is not None:
        pairs = exclude.select(F.col(query_col).cast(query_id), F.col(item_col).cast(item_id))
        exclude = pairs.distinct()
        # Repeated pairs only make blocks finer, which is free while items are broadcast.
        n_pairs = (pairs if small else exclude).count()
    query_blocks = max(
        query_blocks,
        math.ceil(n_pairs / (PAIRS_PER_BLOCK * item_blocks)),
        math.ceil(groups / item_blocks),
    )
    qb, ib = _block(query_col, query_blocks, "_qb"), _block(item_col, item_blocks, "_ib")
    left = asked.select(
        qb, _each(item_blocks, "_ib"), "*", F.lit(None).cast(item_id).alias(item_col)
    )
    if exclude is not None:
        # Empty vectors: after a run of null ones each row is looked through again when it is
        # sent to a worker. Pairs are told by the missing limit.
        nothing = F.array().cast("array<double>").alias("_vector")
        left = left.unionByName(exclude.select(qb, ib, "*", nothing), allowMissingColumns=True)
    groups = min(query_blocks * item_blocks, MAX_GROUPS)
    grouped = left.repartition(groups, "_qb", "_ib").groupBy("_qb", "_ib")
    if small:
        best = grouped.applyInArrow(_per_group(score, prepared.shipped()), schema)
        return best if listed else _finish(best, query_col, temperature)
    right = items.select(
        _each(query_blocks, "_qb"),
        ib,
        item_col,
        F.col(vector_col).cast("array<double>").alias("_vector"),
    )
    blocks = right.repartition(groups, "_qb", "_ib").groupBy("_qb", "_ib")
    best = grouped.cogroup(blocks).applyInArrow(_per_pair(score, item_col), schema)
    if item_blocks > 1:
        order = Window.partitionBy(query_col).orderBy(F.col("score").desc(), item_col)
        best = best.withColumn("rank", F.row_number().over(order))
    best = _finish(best, query_col, temperature)
    return as_lists(best, query_col, item_col) if lists else best


def as_lists(
    ranked: DataFrame, query_col: str = "user_id", item_col: str = "product_id"
) -> DataFrame:
    """Ranked rows to one array ``recs`` per query, best first."""
    entry = F.struct("rank", item_col, "score")
    return ranked.groupBy(query_col).agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),
            lambda x: F.struct(x[item_col].alias(item_col), x["score"].alias("score")),
        ).alias("recs")
    )


def _finish(best: DataFrame, query_col: str, temperature: float | None) -> DataFrame:
    if temperature is not None:
        best = _with_probability(best, query_col, temperature)
    return best.filter(F.col("rank") <= F.col("_limit")).drop("_limit", "_mass")


def _block(key: str, blocks: int, name: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias(name)


def _each(blocks: int, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)


def _with_probability(best: DataFrame, query_col: str, temperature: float) -> DataFrame:
    """Merge the log of the exponential sum that each block reports on its first row."""
    w = Window.partitionBy(query_col)
    peak = F.max("_mass").over(w)
    total = F.sum(F.exp(F.col("_mass") - peak)).over(w)
    share = F.exp(F.col("score") / F.lit(temperature) - peak) / total
    return best.withColumn("probability", share)


def _per_batch(score, shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, index = shipped.value
        for batch in batches:
            yield from score(pa.Table.from_batches([batch]), None, ids, index).to_batches()

    return run


def _per_group(score, shipped):
    def run(asked: pa.Table) -> pa.Table:
        ids, index = shipped.value
        is_query = pc.is_valid(asked["_limit"])
        return score(asked.filter(is_query), asked.filter(pc.invert(is_query)), ids, index)

    return run


def _per_pair(score, item_col: str):
    def run(asked: pa.Table, offered: pa.Table) -> pa.Table:
        offered = offered.take(pc.sort_indices(offered[item_col]))
        ids = offered[item_col].combine_chunks()
        is_query = pc.is_valid(asked["_limit"])
        return score(
            asked.filter(is_query),
            asked.filter(pc.invert(is_query)),
            ids,
            norm_index(as_matrix(offered["_vector"])),
        )

    return run


def _score(query_col, item_col, digits, temperature, listed, scored, rows, pairs, ids, index):
    """Best items of each query row among ``ids`` (sorted), tile by tile."""
    found = []
    if rows.num_rows and len(ids):
        vectors = as_matrix(rows["_vector"])
        limits = rows["_limit"].to_numpy()
        out_q, out_i = _positions(query_col, item_col, rows, pairs, ids)
        step = TILE_QUERIES if temperature is None else TILE_QUERIES_SUMMED
        for start in range(0, len(vectors), step):
            stop = min(start + step, len(vectors))
            a, b = np.searchsorted(out_q, [start, stop])
            best = _best_of(
                vectors[start:stop],
                index,
                limits[start:stop],
                (out_q[a:b] - start, out_i[a:b]),
                digits,
                temperature,
                scored,
            )
            found.append((best[0] + start, *best[1:]))
    q, i, score, rank, mass = (
        (np.concatenate(x) for x in zip(*found, strict=True)) if found else ([],) * 5
    )
    if listed:
        return _lists(query_col, item_col, rows, ids, q, i, score, rank)
    q = pa.array(q, pa.int64())
    return pa.table(
        {
            query_col: rows[query_col].take(q),
            item_col: ids.take(pa.array(i, pa.int64())),
            "score": pa.array(score, pa.float64()),
            "rank": pa.array(rank, pa.int32()),
            "_limit": rows["_limit"].take(q),
            "_mass": pa.array(mass, pa.float64(), from_pandas=True),
        }
    )


def _lists(query_col, item_col, rows, ids, q, i, score, rank) -> pa.Table:
    """One list per query row that has candidates; rows come sorted by query and rank."""
    q, i = np.asarray(q, dtype=np.int64), np.asarray(i, dtype=np.int64)
    score = np.asarray(score, dtype=float)
    if len(q):
        kept = rank <= rows["_limit"].to_numpy()[q]
        q, i, score = q[kept], i[kept], score[kept]
    asked, lengths = np.unique(q, return_counts=True)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    entries = pa.StructArray.from_arrays(
        [ids.take(pa.array(i)), pa.array(score)], names=[item_col, "score"]
    )
    return pa.table(
        {
            query_col: rows[query_col].take(pa.array(asked)),
            "recs": pa.ListArray.from_arrays(offsets, entries),
        }
    )


def _positions(query_col, item_col, rows, pairs, ids):
    """Excluded pairs as (query position, item position), sorted by both."""
    none = np.empty(0, dtype=np.int64)
    if pairs is None or pairs.num_rows == 0:
        return none, none
    q = pc.index_in(pairs[query_col], value_set=rows[query_col].combine_chunks())
    i = pc.index_in(pairs[item_col], value_set=ids)
    known = pc.and_(pc.is_valid(q), pc.is_valid(i))
    q = np.asarray(pc.filter(q, known), dtype=np.int64)
    i = np.asarray(pc.filter(i, known), dtype=np.int64)
    order = np.lexsort((i, q))
    return q[order], i[order]


def _best_of(vectors, index, limits, excluded, digits, temperature, scored=None):
    """Candidates of each item tile, then one ranking per query.

    ``index`` is a ``NormIndex``, or the matrix of sorted ids. Positions that come
    back are those of sorted ids.
    """
    if isinstance(index, np.ndarray):
        index = norm_index(index)
    limits = np.maximum(limits, 1)
    keep, width = int(limits.max()), vectors.shape[1]
    out_q, out_i = excluded[0], index.row[excluded[1]] if len(excluded[1]) else excluded[1]
    order = np.argsort(out_i, kind="stable")
    out_q, out_i = out_q[order], out_i[order]
    outside = np.searchsorted(out_i, index.starts)
    best = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
    found, waiting = [], 0  # candidates that are not merged yet
    lengths = np.linalg.norm(vectors, axis=1)
    last = np.full(len(vectors), -np.inf)  # the score that a further item has to reach
    # Products and rounded scores may exceed the exact bound a little.
    slack = 0.0 if digits is None else 0.5000001 * 10.0**-digits
    near = temperature is None and index.plain and _plain(lengths)
    # Rounding of both vectors, of their products and of the sum, for length 1.
    off = 1.1 * (width + 8) * (2.0**-24 if near else 2.0**-53)
    if near:
        unit = (vectors / np.where(lengths > 0, lengths, 1.0)[:, None]).astype(np.float32)
    sums = None if temperature is None else _Sums(lengths, index, digits, temperature)
    for t, (start, stop, norm) in enumerate(zip(index.starts, index.starts[1:], index.norms)):
        open_ = np.flatnonzero(last <= lengths * norm * (1 + 1e-9) + slack + 1e-300)
        if temperature is not None:
            open_ = np.arange(len(vectors))  # the sum needs every score
        if not len(open_):
            break
        if near:
            tile = unit[open_] @ index.near[start:stop].T
            size = lengths[open_] * norm  # of a score of 1 in the tile
            size[size == 0] = 1.0
            error = np.full(len(open_), off)
        else:
            tile = vectors[open_] @ index.matrix[start:stop].T
            size = np.ones(len(open_))
            error = off * lengths[open_] * norm
        if scored is not None:
            scored.add(tile.size)
        at = np.full(len(vectors), -1)
        at[open_] = np.arange(len(open_))
        here = slice(outside[t], outside[t + 1])
        row, column = at[out_q[here]], out_i[here] - start
        tile[row[row >= 0], column[row >= 0]] = -np.inf
        reach = (last[open_] - slack) / size - error
        q, i, crowded = _reached(tile, reach, keep, 2 * (error + slack / size))
        if len(crowded):  # ties; of equal scores the first ids go on
            more = _first_of(
                vectors[open_[crowded]] @ index.matrix[start:stop].T, tile[crowded], keep, digits
            )
            q, i = np.concatenate([q, crowded[more[0]]]), np.concatenate([i, more[1]])
        if len(q):
            score = _products(vectors, index.matrix, open_[q], i + start)
            if digits is not None:
                score = np.round(score, digits)
            found.append((open_[q], index.place[i + start], score))
            waiting += len(q)
        if waiting >= len(open_):  # until then ``last`` is only lower than it could be
            best = _merged(best, _joined(found), len(vectors), keep)
            full = _ranks(best[0], len(vectors)) == limits[best[0]]
            last[best[0][full]] = best[2][full]
            found, waiting = [], 0
        if sums is not None:
            sums.add(tile)
    if found:
        best = _merged(best, _joined(found), len(vectors), keep)
    q, i, score = best
    rank = _ranks(q, len(vectors))
    mass = np.full(len(q), np.nan)
    if temperature is not None:
        first = rank == 1
        mass[first] = sums.logs(q[first])
    # The first row always stays: it carries the exponential sum.
    kept = rank <= limits[q]
    return q[kept], i[kept], score[kept], rank[kept], mass[kept]


def _reached(tile, reach, keep: int, margin):
    """Entries of each row that are at least ``reach`` and may be among its first ``keep``.

    Entries further apart than ``margin`` are in the right order. Rows where too many
    entries are that close are returned as a list, without their entries.
    """
    kind, width, none = tile.dtype.type, tile.shape[1], np.empty(0, dtype=np.int64)

    def below(x):
        return np.maximum(np.nextafter(x.astype(kind), kind(-np.inf)), np.finfo(kind).min)

    reach = below(reach)
    rows = np.flatnonzero(tile.max(axis=1) >= reach)
    if not len(rows):
        return none, none, none
    if 2 * len(rows) > len(tile):
        rows = np.arange(len(tile))
    some = tile if len(rows) == len(tile) else tile[rows]
    hit = some >= reach[rows, None]
    crowded = np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * keep)
    if len(crowded):
        cut = np.partition(some[crowded], width - keep, axis=1)[:, width - keep]
        cut = np.maximum(reach[rows[crowded]], below(cut - margin[rows[crowded]]))
        hit[crowded] = some[crowded] >= cut[:, None]
        # A product on its own costs several times one in a tile.
        most = max(4 * keep, width // 8)
        crowded = crowded[np.count_nonzero(hit[crowded], axis=1) > most]
        hit[crowded] = False
    q, i = np.divmod(np.flatnonzero(hit), width)
    return rows[q], i, rows[crowded]


def _first_of(scores, tile, keep: int, digits):
    """The ``keep`` largest scores of each row, the first ones of equal scores."""
    if digits is not None:
        scores = np.round(scores, digits)
    scores[~np.isfinite(tile)] = -np.inf
    width = scores.shape[1]
    cut = np.partition(scores, width - keep, axis=1)[:, width - keep]
    above = scores > cut[:, None]
    equal = (scores == cut[:, None]) & np.isfinite(scores)
    free = keep - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (equal & (equal.cumsum(axis=1) <= free)))


def _products(vectors, matrix, q, i) -> np.ndarray:
    """The score of each pair, whatever stands beside it in a tile."""
    found, step = np.empty(len(q)), max(1, GATHERED // max(vectors.shape[1], 1))
    for a in range(0, len(q), step):
        b = a + step
        found[a:b] = np.einsum("bd,bd->b", vectors[q[a:b]], matrix[i[a:b]])
    return found


class _Sums:
    """Sums of exponentials of all scores of a query, over the tiles that are added."""

    def __init__(self, lengths, index: NormIndex, digits, temperature: float):
        self.digits, self.temperature = digits, temperature
        self.sums, self.peak = np.zeros(len(lengths)), np.zeros(len(lengths))
        most = max(lengths, default=0.0) * max(index.norms, default=0.0) / abs(temperature)
        self.moving = not most <= PLAIN_POWER
        if self.moving:
            self.peak[:] = -np.inf

    def add(self, tile: np.ndarray) -> None:
        """Take the scores of a tile, which is overwritten."""
        if self.digits is None:
            tile /= self.temperature
        else:
            tile *= 10.0**self.digits
            np.rint(tile, out=tile)
            tile *= 1.0 / (self.temperature * 10.0**self.digits)
        if self.moving:
            higher = np.maximum(self.peak, tile.max(axis=1))
            some = np.isfinite(higher)
            self.sums[some] *= np.exp(self.peak[some] - higher[some])
            self.peak = higher
            tile -= np.where(some, higher, 0.0)[:, None]
        np.exp(tile, out=tile)
        self.sums += tile.sum(axis=1)

    def logs(self, q: np.ndarray) -> np.ndarray:
        return self.peak[q] + np.log(self.sums[q])


def _ranks(q: np.ndarray, queries: int) -> np.ndarray:
    """Places from 1 within each query of rows in order."""
    return np.arange(len(q)) - np.searchsorted(q, np.arange(queries))[q] + 1


def _joined(found):
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _merged(best, more, queries: int, keep: int):
    """The first ``keep`` of both candidate sets per query, in order."""
    q, i, score = _joined((best, more))
    order = np.lexsort((i, -score, q))
    q, i, score = q[order], i[order], score[order]
    kept = _ranks(q, queries) <= keep
    return q[kept], i[kept], score[kept]
