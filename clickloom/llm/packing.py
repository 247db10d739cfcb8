"""Best-fit packing of documents into sequences of fixed capacity, in bulk rounds.

A round is one step of all sequences at once. Documents and gaps are sorted by
size over the cluster (a range sort each), which gives every row a position.
Sizes are whole numbers up to the capacity, so the counts per size, at most
``capacity`` of them, describe either side in full; one sweep over them in
order of size hands each gap its best fit, the largest document that is left
and not larger. Where several documents want the same gap, positions decide:
the n-th document of a size gets the n-th gap of the interval. Rows meet in a
join on positions, gaps shrink, and the next round begins. Documents that no
gap will hold open sequences. Only counts per size and per partition reach the
driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bpe import CHUNK, MergeEncoder, encoder
from clickloom.llm.common import ID, TEXT, in_arrow, text_or_empty
from clickloom.session import materialize

CAPACITY = 4096
LOW_BITS = 33  # monotonically_increasing_id: partition above, row below


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = ID,
    text_col: str = TEXT,
    keep_ids: bool = False,
) -> DataFrame:
    """Documents as token pieces: id, piece, start, length, ids_crc32 (and ``ids``).

    A document is its ids and ``end_id``; only one longer than ``capacity`` is
    cut. Null texts count as empty (one piece, the end id). Repeated rows give
    repeated pieces; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    end = end_id.to_bytes(4, "little")
    step = 4 * capacity

    def run(batches):
        own = encoder(tokenizer, MergeEncoder)
        own.known.forget()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                row, piece, cut = [], [], []
                for i, ids in enumerate(own.encode(part.column(1).to_pylist())):
                    ids += end
                    for k in range(0, len(ids), step):
                        row.append(i)
                        piece.append(k // step)
                        cut.append(ids[k : k + step])
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array([k * capacity for k in piece], pa.int64()),
                    pa.array([len(x) // 4 for x in cut], pa.int64()),
                    pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                ]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    ends = np.cumsum([0] + [len(x) // 4 for x in cut]).astype("int32")
                    flat = pa.array(np.frombuffer(b"".join(cut), "<i4"), pa.int32())
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        own.known.forget()

    rows = docs.select(id_col, text_or_empty(text_col).alias("_text"))
    return in_arrow(rows, run, schema + (", ids array<int>" if keep_ids else ""))


# --------------------------------------------------------------------------
# The sweep over sizes
# --------------------------------------------------------------------------


RESULT = ("sequence_id", "offset")
TAIL = 10_000  # documents left from which on one plan, of at most as many rows, ends the job


@dataclass
class Interval:
    """Documents of one size at positions [first, last) and where they go.

    Each place from ``slot`` on takes ``run`` of them, ``add`` tokens behind
    what it held before the round. A place is the position of a gap, or if
    ``fresh`` the id of a sequence opened in this round.
    """

    size: int
    first: int
    last: int
    slot: int
    run: int = 1
    add: int = 0
    fresh: bool = False

    @property
    def places(self) -> int:
        return (self.last - self.first) // self.run


@dataclass(order=True)
class Gap:
    """``count`` gaps of one size at places from ``slot`` on; ``add`` is taken in this round."""

    size: int
    slot: int
    count: int
    add: int = 0
    fresh: bool = False


def fit(left: dict[int, list[int]], gaps: list[Gap]) -> tuple[list[Interval], list[Gap]]:
    """Hand each gap its best fit; the moves, and the gaps afterwards.

    ``left`` maps a size to its documents' [next position, end] and is moved
    on. Sizes and gaps are swept upwards, so the largest document not larger
    than a gap is the last one passed. A gap takes one document, or a run of
    equal ones that fills at most half of it.
    """
    moves, after, passed = [], [], []
    sizes = sorted(s for s, (first, end) in left.items() if first < end)
    at = 0
    for gap in sorted(gaps):
        while at < len(sizes) and sizes[at] <= gap.size:
            passed.append(sizes[at])
            at += 1
        slot, count = gap.slot, gap.count
        while count and passed:
            size = passed[-1]
            first, end = left[size]
            run = min(max(1, gap.size // (2 * size)), end - first)
            taken = min(count, (end - first) // run)
            left[size][0] = first = first + taken * run
            moves.append(
                Interval(size, first - taken * run, first, slot, run, gap.add, gap.fresh)
            )
            used = run * size
            after.append(Gap(gap.size - used, slot, taken, gap.add + used, gap.fresh))
            slot, count = slot + taken, count - taken
            if first == end:
                passed.pop()
        if count:
            after.append(Gap(gap.size, slot, count, gap.add, gap.fresh))
    return moves, after


def openings(left: dict[int, list[int]], gaps: list[Gap], capacity: int) -> list[Interval]:
    """Open sequences with the largest documents left.

    Documents of some size or more need gaps of that size or more; what their
    tokens exceed the room there, no packing could do without; half of that is
    opened, as the next rounds fit better with fewer gaps open. At least what
    the largest documents that fit no gap need among themselves.
    """
    rest = [(s, f, e) for s, (f, e) in sorted(left.items(), reverse=True) if f < e]
    if not rest:
        return []
    room, tokens, wanted, at = 0, 0, 0, 0
    down = sorted(gaps, reverse=True)
    for size, first, end in rest:
        tokens += size * (end - first)
        while at < len(down) and down[at].size >= size:
            room += down[at].size * down[at].count
            at += 1
        wanted = max(wanted, -(-(tokens - room) // (2 * capacity)))
    widest = down[0].size if down else 0
    if rest[0][0] > widest:
        share = capacity // rest[0][0]
        alike = sum(e - f for s, f, e in rest if s > widest and capacity // s == share)
        wanted = max(wanted, -(-alike // share))
    opened = []
    for size, first, end in rest:
        taken = min(wanted, end - first)
        if taken:
            opened.append(Interval(size, first, first + taken, first, fresh=True))
            left[size][0] += taken
            wanted -= taken
    return opened


def sweep(
    left: dict[int, list[int]], gaps: list[Gap], capacity: int, tail: int = TAIL
) -> tuple[list[Interval], list[Interval]]:
    """One round: the moves into gaps and the openings.

    Once at most ``tail`` documents are left, the sweep goes on to the end.
    """
    fits, gaps = fit(left, gaps)
    opens = openings(left, gaps, capacity)
    new = opens
    while any(f < e for f, e in left.values()):
        if sum(e - f for f, e in left.values()) > tail:
            break
        gaps += [Gap(capacity - o.size, o.slot, o.places, o.size, True) for o in new]
        more, gaps = fit(left, gaps)
        new = openings(left, gaps, capacity)
        fits, opens = fits + more, opens + new
    return fits, opens


# --------------------------------------------------------------------------
# The rounds on Spark
# --------------------------------------------------------------------------


def _sorted_positions(frame: DataFrame, size: str, *ties: str, label: str, descending: bool):
    """``frame`` in order of ``size`` with its position ``_pos``, and (size, first, count) in order."""
    order = [F.col(size).desc() if descending else F.col(size), *map(F.col, ties)]
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        frame.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("_mid", LOW_BITS).cast("int")
    counts = placed.groupBy(part.alias("_part"), F.col(size).alias("_size")).count().collect()
    counts.sort(key=lambda r: (r["_part"], -r["_size"] if descending else r["_size"]))
    starts, runs, seen = {}, [], 0
    for part_id, value, count in counts:
        starts.setdefault(part_id, seen)
        if runs and runs[-1][0] == value:
            runs[-1] = (value, runs[-1][1], runs[-1][2] + count)
        else:
            runs.append((value, seen, count))
        seen += count
    row = F.col("_mid").bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    # One number per partition: a constant of the plan, where a join would be a job.
    offsets = [starts.get(i, 0) for i in range(max(starts, default=0) + 1)]
    start = F.get(F.lit(offsets).cast("array<long>"), part)
    return placed.withColumn("_pos", start + row).drop("_mid"), runs


def _moved(docs: DataFrame, plan: list[Interval]) -> DataFrame:
    """The documents in the plan's intervals, with their place ``_at`` and ``_shift`` in it.

    A plan has at most two rows per size and gap, or one per document of the
    tail, so it is broadcast.
    """
    rows = [(p.size, p.first, p.last, p.slot, p.run, p.add) for p in plan]
    intervals = docs.sparkSession.createDataFrame(
        rows, "_size long, _first long, _last long, _slot long, _run long, _add long"
    )
    sizes = [p.size for p in plan]
    rank = F.col("_pos") - F.col("_first")
    return (
        docs.where(F.col("length").between(min(sizes), max(sizes)))
        .join(
            F.broadcast(intervals),
            (F.col("length") == F.col("_size"))
            & (F.col("_pos") >= F.col("_first"))
            & (F.col("_pos") < F.col("_last")),
        )
        .withColumn("_at", F.col("_slot") + F.floor(rank / F.col("_run")).cast("long"))
        .withColumn("_shift", F.col("_add") + rank % F.col("_run") * F.col("length"))
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, ties: tuple[str, ...] = (ID, "piece")):
    """``pieces`` with sequence_id and offset; ``length`` is from 1 to ``capacity``.

    Each sequence holds its pieces without gaps from 0. Rows that are alike in
    ``ties`` and length are packed as separate pieces; no rows give no rows.
    Columns named like the results are replaced, those with a leading
    underscore are dropped.
    """
    names = [c for c in pieces.columns if c not in RESULT and not c.startswith("_")]
    pieces = materialize(pieces.select(*names), "pack-input")  # the range sort reads it twice
    docs, runs = _sorted_positions(pieces, "length", *ties, label="pack-pieces", descending=True)
    if runs and not 1 <= runs[-1][0] <= runs[0][0] <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    left = {size: [first, first + count] for size, first, count in runs}
    placed: list[DataFrame] = []
    gaps: DataFrame | None = None
    gap_runs: list[Gap] = []
    while any(first < end for first, end in left.values()):
        fits, opens = sweep(left, gap_runs, capacity)
        old = [p for p in fits if not p.fresh]
        fresh = [p for p in fits if p.fresh] + opens
        moved = []
        if old:
            place = gaps.select(F.col("_pos").alias("_gap_pos"), "_seq", "_used")
            moved.append(
                _moved(docs, old)
                .join(place, F.col("_at") == F.col("_gap_pos"))
                .withColumn("sequence_id", F.col("_seq"))
                .withColumn("offset", F.col("_used") + F.col("_shift"))
                .select(*names, *RESULT)
            )
        if fresh:
            moved.append(
                _moved(docs, fresh)
                .withColumn("sequence_id", F.col("_at"))
                .withColumn("offset", F.col("_shift"))
                .select(*names, *RESULT)
            )
        if moved:
            placed.append(materialize(_union(moved), "pack-placed"))
        smallest = min((s for s, (first, end) in left.items() if first < end), default=None)
        if smallest is None:
            break
        after = [] if gaps is None else [_shrunk(gaps, old)]
        if opens:  # their first documents are those placed at 0
            opened = placed[-1].where("offset = 0")
            after.append(opened.select(F.col("sequence_id").alias("_seq"), F.col("length").alias("_used")))
        table = _union(after).withColumn("_gap", F.lit(capacity) - F.col("_used"))
        gaps, found = _sorted_positions(
            table.where(F.col("_gap") >= smallest),
            "_gap",
            "_seq",
            label="pack-gaps",
            descending=False,
        )
        gap_runs = [Gap(*run) for run in found]
    if not placed:
        empty = pieces.limit(0)
        for name in RESULT:
            empty = empty.withColumn(name, F.lit(0).cast("long"))
        return empty
    return _union(placed)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _shrunk(gaps: DataFrame, moves: list[Interval]) -> DataFrame:
    """The gaps after a round; those that took documents have used more."""
    if not moves:
        return gaps.select("_seq", "_used")
    # In order of position; a gap finds its interval by the last start not behind it.
    moves = sorted(moves, key=lambda p: p.slot)
    starts = [p.slot for p in moves]
    ends = [p.slot + p.places for p in moves]
    added = [p.run * p.size for p in moves]

    def run(batches):
        first, last, add = (np.array(x, "int64") for x in (starts, ends, added))
        for batch in batches:
            seq, used, pos = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = np.searchsorted(first, pos, "right") - 1
            inside = (at >= 0) & (pos < last[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(seq), pa.array(used + np.where(inside, add[at], 0))],
                names=["_seq", "_used"],
            )

    return gaps.select("_seq", "_used", "_pos").mapInArrow(run, "`_seq` long, `_used` long")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """Each sequence's ids in order, from packed pieces that kept their ``ids``.

    A sequence holds at most ``capacity`` ids, which bounds the group.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
