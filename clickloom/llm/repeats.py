"""Removal of repeated passages by prefix-free parsing of the corpus.

A byte goes when a window of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Sorting all suffixes would answer that; parsing makes
the sort short:

* *Triggers.* In every window the 16-byte string with the least rolling hash is its
  trigger (the leftmost of equal ones). Equal windows have equal triggers at equal
  places, however the texts around them differ.
* *Phrases.* Consecutive windows with one trigger form a phrase, some 19 windows
  long on prose, so a phrase and the bytes its last window reaches are a function
  of content alone, and every window lies in just one phrase.
* *Dictionary.* Phrases are sorted by trigger and content. All places of an entry
  but those in its least document are repeats as a whole; what is repeated often
  is decided here, once per phrase and not per byte.
* *Parse.* Entries that share a trigger, differ, and agree on 16 more bytes on one
  side of it (any common window reaches at least 17 past one side) may still
  share windows at their ends. Only these are unfolded into windows, which are
  sorted and grouped in turn.

Only equality to a fixed depth matters, so hashes of phrases and windows stand in
for the strings in both sorts: 96 and 128 bits. Rows are (hash, hash, document),
never text. A task decides the groups of its sorted rows as it meets them; a trigger
or window that more than ``GROUP`` rows have is left to window functions, which spill.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, bounded, text_or_empty
from clickloom.session import materialize

LENGTH = 50
TRIGGER, SIDE = 16, 16
LEAST_LENGTH = TRIGGER + 2 * SIDE
# Bytes hashed at a time; a phrase ends at the end of a long text's slice.
SLICE = 1 << 16
# What a phrase or window is that goes as a whole; below, the sides of a trigger.
WHOLE = 4
# Rows of one trigger or window that a task holds.
GROUP = 1 << 20
PLACE = np.uint64((1 << 24) - 1)
LOW16 = np.uint64(0xFFFF)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring strings to the hash of both."""
    h = left * ODD[1]
    h += right
    h *= ODD[2]
    h ^= h >> np.uint64(31)
    return h


class Hashes:
    """Rolling hashes of substrings of a given size, by doubling."""

    def __init__(self, data: bytes):
        x = (np.frombuffer(data, "u1").astype("u8") + np.uint64(1)) * ODD[0]
        self.levels = [x ^ (x >> np.uint64(29))]

    def level(self, level: int) -> np.ndarray:
        """The hash of the 2^level bytes from each place on."""
        while len(self.levels) <= level:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_joined(last[:-half], last[half:]))
        return self.levels[level]

    def at(self, size: int, places: np.ndarray) -> np.ndarray:
        """The hash of the ``size`` bytes from the given places on."""
        out = None
        for level in reversed(range(size.bit_length())):
            if size >> level & 1:
                part = self.level(level)[places]
                out = part if out is None else _joined(out, part)
                places = places + (1 << level)
        return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Block(NamedTuple):
    """Texts, or slices of long ones, put one behind the other."""

    data: bytes
    start: np.ndarray  # of each part in ``data``
    end: np.ndarray
    row: np.ndarray  # the text it is from
    place: np.ndarray  # and where in it


def blocks(texts: list[bytes], length: int, size: int | None = None) -> Iterator[Block]:
    """Blocks of about ``size`` bytes in which every window of every text lies once."""
    size = size or SLICE
    parts, total = [], 0

    def block():
        data, rows, places = zip(*parts)
        ends = np.cumsum([len(d) for d in data])
        start = ends - [len(d) for d in data]
        return Block(b"".join(data), start, ends, np.array(rows), np.array(places))

    for row, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, size):
            parts.append((text[at : at + size + length - 1], row, at))
            total += len(parts[-1][0])
            if total >= size:
                yield block()
                parts, total = [], 0
    if parts:
        yield block()


class Phrases:
    """The phrases of a block: windows from ``start`` up to ``end`` with one trigger.

    The upper 48 bits of ``a`` hash the trigger, those of ``b`` the phrase (its first and
    last window cover it); the lower 16 tell what stands left and right of the trigger,
    0 if the text or slice ends there.
    """

    def __init__(self, block: Block, length: int):
        self.length, self.hashes = length, Hashes(block.data)
        grams = self.hashes.level(TRIGGER.bit_length() - 1)
        ranked = (grams & ~PLACE) | np.arange(len(grams), dtype="u8")
        place = (_least(ranked, length - TRIGGER + 1) & PLACE).astype("i8")
        part = np.repeat(np.arange(len(block.start)), block.end - block.start)[: len(place)]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (part[1:] != part[:-1])
        new &= np.arange(length, len(place) + length) <= block.end[part]
        self.start = np.flatnonzero(new)
        self.part = part[self.start]
        self.row = block.row[self.part]
        last = block.end[self.part] - length + 1
        self.end = np.minimum(np.append(self.start[1:], len(place)), last)
        self.place = place[self.start]
        ends = [self.hashes.at(length, at) for at in (self.start, self.end - 1)]
        content = _joined(_joined(*ends), (self.end - self.start).astype("u8"))
        behind = self.place + TRIGGER + SIDE <= block.end[self.part]
        before = self.place - SIDE >= block.start[self.part]
        self.a = (grams[self.place] & ~LOW16) | self._side(self.place - SIDE, before)
        self.b = (content & ~LOW16) | self._side(self.place, behind)

    def _side(self, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        """A tag of the trigger and ``SIDE`` bytes beside it."""
        tag = self.hashes.at(TRIGGER + SIDE, np.where(known, at, 0)) >> np.uint64(40)
        return np.where(known, np.maximum(tag & LOW16, np.uint64(1)), np.uint64(0))

    def key(self) -> np.ndarray:
        return self.a ^ self.b

    def windows(self, chosen: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, phrase) of the windows of chosen phrases that reach far enough on the sides.

        ``sides`` is 1 where others share the left side, 2 for the right one, 3 for both.
        A window has ``length - TRIGGER`` bytes beside its trigger. If those on one side
        that are not shared number ``SIDE`` or more, it is not repeated.
        """
        start, end, place = self.start[chosen], self.end[chosen], self.place[chosen]
        beside = self.length - TRIGGER
        first = np.where(sides & 1, start, np.maximum(start, place - SIDE + 1))
        last = np.where(sides & 2, end, np.minimum(end, place - beside + SIDE))
        count = np.maximum(last - first, 0)
        which = np.repeat(np.arange(len(chosen)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[which]
        return at, chosen[which]


def _of_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that hold for one row of a batch only."""
    return (keys ^ (row.astype("u8") * ODD[1])) * ODD[2]


def _listed(lists: pa.ListArray) -> np.ndarray:
    """The unsigned values of lists, each marked with its row, unsorted."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).view("u8")
    return _of_row(flat, pc.list_parent_indices(lists).to_numpy(zero_copy_only=False))


def _places(keys: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Where each key stands in the sorted ``listed``; -1 if it does not."""
    if not len(listed):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(listed, keys), len(listed) - 1)
    return np.where(listed[at] == keys, at, -1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view("i8"))


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """The first place of each distinct combination."""
    order = np.lexsort(columns)
    return order[_starts(*(c[order] for c in columns))]


def phrase_rows(docs: DataFrame, length: int) -> DataFrame:
    """(a, b, doc): the distinct phrases of every row of (doc, data)."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block in blocks(batch.column(1).to_pylist(), length):
                found = Phrases(block, length)
                doc = ids[found.row]
                some = _distinct(found.a, found.b, doc)
                yield pa.RecordBatch.from_arrays(
                    [_signed(found.a[some]), _signed(found.b[some]), pa.array(doc[some])],
                    names=["a", "b", "doc"],
                )

    return docs.mapInArrow(run, "a long, b long, doc long")


def window_rows(docs: DataFrame, length: int) -> DataFrame:
    """(w, v, doc): windows of the phrases that each row (doc, data, keys, sides) lists."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            listed, sides = _listed(batch.column(2)), batch.column(3).flatten().to_numpy()
            order = np.argsort(listed)
            listed, sides = listed[order], sides[order]
            for block in blocks(batch.column(1).to_pylist(), length):
                found = Phrases(block, length)
                at = _places(_of_row(found.key(), found.row), listed)
                chosen = np.flatnonzero(at >= 0)
                place, phrase = found.windows(chosen, sides[at[chosen]])
                doc = ids[found.row[phrase]]
                w, v = found.hashes.at(length, place), _second(found.hashes, length, place)
                some = _distinct(w, v, doc)
                yield pa.RecordBatch.from_arrays(
                    [_signed(w[some]), _signed(v[some]), pa.array(doc[some])],
                    names=["w", "v", "doc"],
                )

    return docs.mapInArrow(run, "w long, v long, doc long")


def _second(hashes: Hashes, length: int, place: np.ndarray) -> np.ndarray:
    """Another hash of the windows, from other pieces of them."""
    size = TRIGGER // 2
    out = np.zeros(len(place), "u8")
    for at in [*range(0, length - size, size), length - size]:
        out = (out ^ hashes.level(size.bit_length() - 1)[place + at]) * ODD[1]
        out ^= out >> np.uint64(32)
    return out


def spans_of(
    texts: list[bytes], whole: np.ndarray, single: np.ndarray, length: int
) -> list[list[tuple[int, int]]]:
    """Per text: the maximal runs of bytes in the listed phrases (``whole``) and windows.

    Both lists are sorted and hold keys marked with their row.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for block in blocks(texts, length):
        own = Phrases(block, length)
        cover = np.zeros(len(block.data) + 1, "i4")
        gone = _places(_of_row(own.key(), own.row), whole) >= 0
        np.add.at(cover, own.start[gone], 1)
        np.add.at(cover, own.end[gone] + length - 1, -1)
        if len(single):
            every = np.ones(len(own.start), "i8") * 3
            place, phrase = own.windows(np.flatnonzero(~gone), every[~gone])
            keys = _of_row(own.hashes.at(length, place), own.row[phrase])
            place = place[_places(keys, single) >= 0]
            np.add.at(cover, place, 1)
            np.add.at(cover, place + length, -1)
        depth = np.cumsum(cover[:-1]) > 0
        edges = np.flatnonzero(depth[1:] != depth[:-1]) + 1
        # A run may go on into the next part; parts are cut there.
        edges = np.unique(np.concatenate([edges, block.start, block.end]))
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if depth[s]:
                part = np.searchsorted(block.start, s, "right") - 1
                shift = int(block.place[part] - block.start[part])
                _add(found[block.row[part]], s + shift, e + shift)
    return found


def _add(spans: list[tuple[int, int]], start: int, end: int) -> None:
    """Append a span, merged with those before that it meets; slices overlap."""
    while spans and spans[-1][1] >= start:
        before = spans.pop()
        start, end = min(before[0], start), max(before[1], end)
    spans.append((start, end))


def _cleaned(rows: DataFrame, id_col: str, length: int) -> DataFrame:
    """(id, spans, kept) of rows (id, data, keys of phrases, keys of windows)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lists = [np.sort(_listed(batch.column(i))) for i in (2, 3)]
            spans = spans_of(texts, *lists, length)
            kept = []
            for text, gone in zip(texts, spans):
                edges = [0, *(x for span in gone for x in span), len(text)]
                kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])))
            named = [[{"start": s, "end": e} for s, e in gone] for gone in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, kind), pa.array(kept, pa.binary())],
                names=[id_col, "spans", "kept"],
            )

    own = rows.schema[id_col].dataType.simpleString()
    spans = "array<struct<start: long, end: long>>"
    return rows.mapInArrow(run, f"`{id_col}` {own}, spans {spans}, kept binary")


# --------------------------------------------------------------------------
# Groups of equal triggers, and of equal windows
# --------------------------------------------------------------------------


def _whole_groups(batches, group, largest: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Columns of sorted rows cut between groups, and whether they are of too large a group."""
    held, over = np.empty((3, 0), "i8"), None
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
        rows = np.concatenate([held, rows], axis=1)
        names = group(rows[0])
        if over is not None:
            more = int(np.argmax(np.append(names, ~over) != over))
            if more:
                yield rows[:, :more], True
            rows, names = rows[:, more:], names[more:]
        ends = np.flatnonzero(names[1:] != names[:-1])
        last = int(ends[-1]) + 1 if len(ends) else 0
        if last:
            yield rows[:, :last], False
        held, over = rows[:, last:], None
        if held.shape[1] > largest:
            over = names[-1]
            yield held, True
            held = held[:, :0]
    if held.shape[1]:
        yield held, False


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows alike in all columns begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _common(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The rows of groups that have two documents at least; groups are contiguous."""
    if not len(doc):
        return np.empty(0, "i8")
    start = np.flatnonzero(_starts(group))
    size = np.diff(start, append=len(doc))
    shared = np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start)
    return np.flatnonzero(np.repeat(shared, size))


def _first(doc: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """The least document among the rows alike in ``columns``, for every row."""
    order = np.lexsort((doc, *columns))
    new = _starts(*(c[order] for c in columns))
    first = np.empty(len(doc), "i8")
    first[order] = doc[order][new][np.cumsum(new) - 1]
    return first


def _differ(value: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Whether the rows alike in ``columns`` have more than one value."""
    order = np.lexsort((value, *columns))
    new = _starts(*(c[order] for c in columns))
    run, start = np.cumsum(new) - 1, np.flatnonzero(new)
    last = start + np.diff(start, append=len(value)) - 1
    out = np.empty(len(value), bool)
    out[order] = (value[order][start] != value[order][last])[run]
    return out


def _phrase_verdicts(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> dict[str, np.ndarray]:
    rows = _common(a >> 16, doc)
    a, b, doc = a[rows], b[rows], doc[rows]
    trigger, phrase = a >> 16, b >> 16
    whole = doc > _first(doc, trigger, phrase)
    sides = np.zeros(len(doc), "i4")
    for bit, side in ((1, a & 0xFFFF), (2, b & 0xFFFF)):
        sides |= bit * (_differ(phrase, trigger, side) & (side != 0))
    return {"doc": doc, "key": a ^ b, "sides": np.where(whole, WHOLE, sides).astype("i4")}


def _window_verdicts(w: np.ndarray, v: np.ndarray, doc: np.ndarray) -> dict[str, np.ndarray]:
    rows = _common(w, doc)
    w, v, doc = w[rows], v[rows], doc[rows]
    again = doc > _first(doc, w, v)
    return {"doc": doc, "key": w, "sides": np.where(again, WHOLE, 0).astype("i4")}


def _grouped(rows: DataFrame, shift: int, verdicts, largest: int) -> DataFrame:
    """(doc, key, sides) of rows of three longs, the document last.

    Rows are dealt and sorted by the first column without its lower ``shift`` bits; the
    rows of a larger group come back with the first two columns set.
    """
    x, y, _ = rows.columns

    def run(batches):
        for (p, q, doc), over in _whole_groups(batches, lambda c: c >> shift, largest):
            if over:
                blank = [pa.nulls(len(doc), pa.int64()), pa.nulls(len(doc), pa.int32())]
                columns = [pa.array(doc), *blank, pa.array(p), pa.array(q)]
            else:
                found = verdicts(p, q, doc)
                kept = found["sides"] != 0
                columns = [pa.array(c[kept]) for c in found.values()]
                columns += [pa.nulls(int(kept.sum()), pa.int64())] * 2
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "key", "sides", x, y])

    dealt = rows.repartition(F.shiftright(x, shift)).sortWithinPartitions(x)
    kinds = f"doc long, key long, sides int, {x} long, {y} long"
    return dealt.mapInArrow(run, kinds)


def _phrases_by_windows(rows: DataFrame) -> DataFrame:
    """``_phrase_verdicts`` for triggers of any frequency, by window functions that spill."""
    trigger = Window.partitionBy("_t")
    first = F.min("doc").over(Window.partitionBy("_t", "_p"))
    sides = rows.select(
        "doc",
        F.col("a").bitwiseXOR(F.col("b")).alias("key"),
        F.shiftright("a", 16).alias("_t"),
        F.shiftright("b", 16).alias("_p"),
        F.col("a").bitwiseAND(0xFFFF).alias("_l"),
        F.col("b").bitwiseAND(0xFFFF).alias("_r"),
    )
    sides = sides.withColumn("_whole", F.col("doc") > first)
    sides = sides.withColumn("_low", F.min("doc").over(trigger))
    sides = sides.withColumn("_high", F.max("doc").over(trigger)).where("_low < _high")
    shared = F.lit(0)
    for bit, side in ((1, "_l"), (2, "_r")):
        alike = Window.partitionBy("_t", side)
        many = (F.min("_p").over(alike) < F.max("_p").over(alike)) & (F.col(side) != 0)
        shared += F.when(many, bit).otherwise(0)
    return sides.select(
        "doc", "key", F.when(F.col("_whole"), WHOLE).otherwise(shared).alias("sides")
    ).where("sides <> 0")


def _windows_by_windows(rows: DataFrame) -> DataFrame:
    first = F.min("doc").over(Window.partitionBy("w", "v"))
    again = rows.withColumn("_first", first).where(F.col("doc") > F.col("_first"))
    return again.select("doc", F.col("w").alias("key"), F.lit(WHOLE).alias("sides"))


def _decided(rows: DataFrame, shift: int, verdicts, by_windows, largest: int) -> DataFrame:
    found = materialize(_grouped(rows, shift, verdicts, largest), "repeats")
    decided = found.where("key IS NOT NULL").select("doc", "key", "sides")
    left = found.where("key IS NULL").select(*rows.columns)
    if left.isEmpty():
        return decided
    return decided.unionByName(materialize(by_windows(left), "repeats-large"))


def repeated_keys(docs: DataFrame, length: int = LENGTH, largest: int = GROUP) -> DataFrame:
    """(_doc, _whole, _single): per document the phrases, and the windows, that also start in
    a document with a smaller id. Documents without any are left out.

    ``docs`` has (doc long, data binary), no null. Groups of more than ``largest`` rows
    are decided by window functions.
    """
    phrases = _decided(
        phrase_rows(docs, length), 16, _phrase_verdicts, _phrases_by_windows, largest
    )
    ends = phrases.where(F.col("sides") != WHOLE).groupBy(F.col("doc").alias("_doc")).agg(
        F.collect_list(F.struct("key", "sides")).alias("_ends")
    )
    ends = materialize(ends, "repeats-ends")
    some = bounded(ends.select(F.col("_doc").alias("_id")))
    texts = docs.join(some, F.col("doc") == F.col("_id"), "left_semi")
    rows = texts.join(ends, F.col("doc") == F.col("_doc")).select(
        "doc", "data", F.col("_ends.key").alias("_keys"), F.col("_ends.sides").alias("_sides")
    )
    windows = _decided(
        window_rows(rows, length), 0, _window_verdicts, _windows_by_windows, largest
    )
    whole = phrases.where(F.col("sides") == WHOLE).select("doc", "key", F.lit(True).alias("_of"))
    gone = whole.unionByName(windows.select("doc", "key", F.lit(False).alias("_of")))
    lists = [
        F.collect_list(F.when(F.col("_of") == of, F.col("key"))).alias(name)
        for of, name in ((True, "_whole"), (False, "_single"))
    ]
    return gone.groupBy(F.col("doc").alias("_doc")).agg(*lists)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = ID, text_col: str = TEXT
) -> DataFrame:
    """(id, n_bytes, spans, kept): what is left of every text when repeated bytes go.

    ``spans`` are the maximal removed runs (byte places, end exclusive), ``kept`` the
    remaining bytes, which need not be valid UTF-8. Ids are integers. Null texts are
    empty; rows with a null id keep all bytes and remove none elsewhere. Of rows with
    the same id none is smaller, so repeats between them stay. An empty table gives
    no rows; other columns are ignored.
    """
    if length < LEAST_LENGTH:
        raise ValueError(f"windows have at least {LEAST_LENGTH} bytes")
    data = F.encode(text_or_empty(text_col), "UTF-8")
    known = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), data.alias("data")
    )
    lists = materialize(
        repeated_keys(known.where(F.octet_length("data") >= length), length), "repeats-keys"
    )
    rows = docs.select(id_col, data.alias("_data"))
    some = bounded(lists.select(F.col("_doc").alias("_id")))
    own = F.col(id_col).cast("long")
    left = rows.join(some, own == F.col("_id"), "left_semi").join(lists, own == F.col("_doc"))
    cleaned = _cleaned(left.select(id_col, "_data", "_whole", "_single"), id_col, length)
    none = F.array().cast(cleaned.schema["spans"].dataType)
    rest = rows.join(some, own == F.col("_id"), "left_anti")
    untouched = rest.select(id_col, none.alias("spans"), F.col("_data").alias("kept"))
    gone = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return cleaned.unionByName(untouched).select(
        id_col, (F.octet_length("kept") + gone).cast("long").alias("n_bytes"), "spans", "kept"
    )
