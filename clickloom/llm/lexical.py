"""Ranked lexical search by NRA over impact-sorted postings of document shards.

The scan of the texts writes, per document, its length and the counts of the terms
that any item asks for. Totals and document frequencies are aggregated from that
table. Then every task cuts its documents into shards, sorts each shard's postings
by term and falling impact, and answers every item by sequential reads alone (no
random access): per document a lower score (what was read) and an upper score (plus
the last impact read of each list in which it has not appeared). Reading goes on
until no unread document can reach the k-th lower score and the interval of every
document that can has closed, so membership, ties and scores are exact. A task keeps
the k-th score of its earlier shards as a floor for the later ones. The best of all
shards meet in a ranked window, cut below the shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import ID, TEXT, text_or_empty
from clickloom.session import materialize

TOP = 20
# Distinct terms of one block of items, which bounds what a block broadcasts.
BLOCK_TERMS = 1_000_000
# Postings of a shard at most, but for a single longer document.
SHARD_POSTINGS = 2_000_000
FIRST_READ = 64
PIECE = 1 << 20
# ASCII but digits and letters separates; A-Z is lower-cased.
FOLD = bytes(
    ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() else 32 for b in range(128)
) + bytes(range(128, 256))


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in pieces of bounded size."""
    flat, at = text.translate(FOLD), 0
    while at < len(flat):
        stop = flat.find(b" ", at + PIECE)
        stop = len(flat) if stop < 0 else stop
        yield flat[at:stop].split()
        at = stop


def _lists(flat: list, sizes: list) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, terms, times): the distinct terms of each item and how often it has them."""

    def run(batches):
        for batch in batches:
            terms, times, sizes = [], [], []
            for text in batch.column(1).to_pylist():
                found = Counter()
                for piece in words(text):
                    found.update(piece)
                terms += found
                times += found.values()
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    _lists(pa.array(terms, pa.binary()), sizes),
                    _lists(pa.array(times, pa.int64()), sizes),
                ],
                names=[item_col, "terms", "times"],
            )

    kind = items.schema[item_col].dataType.simpleString()
    rows = items.select(item_col, F.encode(text_or_empty(text_col), "UTF-8").alias("_text"))
    return rows.mapInArrow(run, f"`{item_col}` {kind}, terms array<binary>, times array<long>")


def _index(docs: DataFrame, known, id_col: str, text_col: str) -> DataFrame:
    """(id, length, terms, counts): each document's length and its counts of known terms."""

    def run(batches):
        place = known.value
        for batch in batches:
            lengths, terms, counts, sizes = [], [], [], []
            for text in batch.column(1).to_pylist():
                length, found = 0, Counter()
                for piece in words(text):
                    length += len(piece)
                    found.update(map(place.get, piece))
                found.pop(None, None)
                lengths.append(length)
                terms += found
                counts += found.values()
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    _lists(pa.array(terms, pa.int32()), sizes),
                    _lists(pa.array(counts, pa.int32()), sizes),
                ],
                names=[id_col, "length", "terms", "counts"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.encode(text_or_empty(text_col), "UTF-8").alias("_text"))
    schema = f"`{id_col}` {kind}, length long, terms array<int>, counts array<int>"
    return rows.mapInArrow(run, schema)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def read_lists(lists, docs, impacts, n_docs: int, order, k: int, floor: int):
    """The best ``k`` documents (position, score) of one item, by sequential reads.

    ``lists`` holds (times, start, end) slices of ``docs`` and ``impacts``, each
    sorted by falling impact; ``order`` ranks documents of equal scores. Documents
    that score below ``floor`` may be left out.
    """
    low = np.zeros(n_docs, "i8")
    seen = np.zeros((len(lists), n_docs), bool)
    at, bound, depth = [a for _, a, _ in lists], np.zeros(len(lists), "i8"), FIRST_READ
    while True:
        for t, (times, _, end) in enumerate(lists):
            stop = min(at[t] + depth, end)
            here = docs[at[t] : stop]  # a list names a document once
            low[here] += times * impacts[at[t] : stop]
            seen[t, here] = True
            at[t] = stop
            bound[t] = times * impacts[stop] if stop < end else 0
        depth *= 2
        unread = int(bound.sum())
        found = np.flatnonzero(low)
        kth = int(np.partition(low[found], len(found) - k)[-k]) if len(found) >= k else 0
        kth = max(kth, floor, 1)
        found = found[low[found] + unread >= kth]
        high = low[found] + unread - bound @ seen[:, found]
        found = found[high >= kth]
        if unread < kth and (high[high >= kth] == low[found]).all():
            best = found[np.lexsort((order[found], -low[found]))[:k]]
            return best, low[best]


def _shard(rows: pa.Table, id_col: str, items, weights, documents: int, total: int, k, floors):
    """The best documents of one shard for every item: (item, id, score) arrays."""
    length = rows["length"].to_numpy()
    terms, counts = (rows[c].combine_chunks() for c in ("terms", "counts"))
    sizes = np.diff(terms.offsets.to_numpy())
    terms, counts = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype("i8")
    mass = 100 - 25 + (25 * length * documents) // total
    docs = np.repeat(np.arange(len(length)), sizes)
    impacts = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * mass[docs]))
    by = np.lexsort((-impacts, terms))
    by = by[impacts[by] > 0]
    terms, docs, impacts = terms[by], docs[by], impacts[by]
    # Equal scores go by id, ids that are null first.
    order = np.empty(len(length), "i8")
    sort = pc.sort_indices(rows, [(id_col, "ascending")], null_placement="at_start")
    order[sort.to_numpy()] = np.arange(len(length))
    which, places, scores = [], [], []
    for item, (asked, times) in enumerate(items):
        start, end = np.searchsorted(terms, asked), np.searchsorted(terms, asked, "right")
        lists = [x for x in zip(times.tolist(), start.tolist(), end.tolist()) if x[1] < x[2]]
        if lists:
            best, score = read_lists(lists, docs, impacts, len(length), order, k, floors[item])
            if len(best) == k:
                floors[item] = max(floors[item], int(score[-1]))
            which.append(np.full(len(best), item))
            places.append(best)
            scores.append(score)
    none = [np.empty(0, "i8")]
    which, places, scores = (np.concatenate(x or none) for x in (which, places, scores))
    return which, rows[id_col].take(pa.array(places)), scores


def _ranked(index, items, weights, documents, total, id_col, k, postings):
    """(_item, id, score): the best ``k`` of each shard, shards cut from the tasks' rows."""

    def shards(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                held.append(batch.slice(at, 256))
                size += int(pc.sum(pc.list_value_length(held[-1]["terms"])).as_py())
                if size >= postings:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        asked, w = items.value, weights.value
        floors = [0] * len(asked)
        for rows in shards(batches):
            which, ids, scores = _shard(rows, id_col, asked, w, documents, total, k, floors)
            yield from pa.table({"_item": which, id_col: ids, "score": scores}).to_batches()

    kind = index.schema[id_col].dataType.simpleString()
    return index.mapInArrow(run, f"_item long, `{id_col}` {kind}, score long")


def _search_block(docs, asked, id_col, text_col, k, postings) -> DataFrame | None:
    """Answer one block of items, whose terms are few enough to be broadcast."""
    spark = docs.sparkSession
    place: dict[bytes, int] = {}
    items = []
    for terms, times in asked:
        for term in terms:
            place.setdefault(bytes(term), len(place))
        at = np.array([place[bytes(term)] for term in terms], "i4")
        items.append((at, np.array(times, "i8")))
    ship = spark.sparkContext.broadcast
    known = ship(place)
    index = materialize(_index(docs, known, id_col, text_col), "lexical-index")
    known.unpersist()
    documents, total = index.agg(F.count_if(F.col("length") > 0), F.sum("length")).first()
    if not documents:
        return None
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = np.zeros(len(place), "i8")
    for term, count in holding.collect():  # at most one row per term of the block
        weights[term] = weight(documents, count)
    best = _ranked(index, ship(items), ship(weights), documents, total, id_col, k, postings)
    by_score = Window.partitionBy("_item").orderBy(
        F.col("score").desc(), F.col(id_col).asc_nulls_first()
    )
    return best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = ID,
    text_col: str = TEXT,
    item_col: str = "item_id",
    item_text_col: str = TEXT,
    block_terms: int = BLOCK_TERMS,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """(item, rank, document, score): each item's ``k`` best documents with a score above 0.

    Equal scores go by ascending id, a null id first. Null and empty texts have no
    term: such documents rank nowhere and such items have no rows. Repeated rows
    count, and are ranked, one by one; every row of a repeated item is answered. An
    empty table on either side gives no rows. Other columns are ignored. Items whose
    terms exceed ``block_terms`` are answered in blocks, each with a scan of its own.
    """
    spark = docs.sparkSession
    asked = materialize(
        _item_terms(items, item_col, item_text_col).where(F.size("terms") > 0), "lexical-items"
    )
    terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = math.ceil(terms / block_terms)
    block = F.pmod(F.xxhash64("terms", "times"), F.lit(max(blocks, 1)))
    named = T.StructType([T.StructField("_no", T.LongType()), asked.schema[item_col]])
    parts = []
    for number in range(blocks):
        rows = asked.where(block == number).collect()
        lists = [(row["terms"], row["times"]) for row in rows]
        best = _search_block(docs, lists, id_col, text_col, k, shard_postings)
        if best is not None:
            numbers = [(no, row[item_col]) for no, row in enumerate(rows)]
            names = F.broadcast(spark.createDataFrame(numbers, named))
            best = best.withColumnRenamed(id_col, "_doc").join(names, F.col("_item") == F.col("_no"))
            parts.append(best.select(item_col, "rank", F.col("_doc").alias(id_col), "score"))
    if not parts:
        answer = [asked.schema[item_col], T.StructField("rank", T.IntegerType())]
        answer += [docs.schema[id_col], T.StructField("score", T.LongType())]
        return spark.createDataFrame([], T.StructType(answer))
    return reduce(DataFrame.unionByName, parts)
