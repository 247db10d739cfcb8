"""Click sequences to vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.clicks import fit_sequence
from clickloom.operators.matrix import (
    BROADCAST_BYTES,
    Size,
    as_lists,
    as_matrix,
    broadcast_items,
    measure,
)
from clickloom.session import materialize

SEQUENCES_PER_BLOCK = 20_000


def encode_sequences(
    requests: DataFrame,
    items: DataFrame,
    weights: Sequence[float],
    key_col: str = "request_id",
    seq_col: str = "click_sequence",
    broadcast_bytes: int = BROADCAST_BYTES,
    per_block: int = SEQUENCES_PER_BLOCK,
    keep: Sequence[str] = (),
    score: str | None = None,
) -> DataFrame:
    """``sum(w[pos] * E[item]) / known items`` for each sequence, as ``factor``.

    The columns ``keep`` are carried along. ``score`` names one of them that holds an
    item; then ``score``, the product of that item's vector and the sequence's, comes in
    place of ``factor``, null for an unknown item, and no vector leaves a task.

    Sequences are cut to the last K items and padded on the left; an unknown
    item keeps its place but adds nothing. With a small item table, or few items that
    are mentioned, this is a narrow step. Otherwise requests are hashed into blocks and each block is
    joined with the distinct item rows it mentions, so a popular item (padding
    above all) travels once per block and not once per click.
    """
    items = items.filter(F.col("factor").isNotNull())
    size = measure(items, "product_id")
    found = T.StructField("factor", T.ArrayType(T.DoubleType()))
    if score is not None:
        found = T.StructField("score", T.DoubleType())
    schema = T.StructType([*[requests.schema[c] for c in (key_col, *keep)], found])
    clicks = fit_sequence(F.col(seq_col), len(weights)).alias("_clicks")
    places = np.array(weights)
    mentions = F.col("_clicks")
    if score is not None:
        mentions = F.concat(mentions, F.array(F.col(score).cast("string")))
    if size.rows and size.bytes > broadcast_bytes:
        asked = requests.select(clicks, *([score] if score else []))
        asked = asked.select(F.explode(mentions).alias("product_id")).distinct()
        items = materialize(
            items.select("product_id", "factor").join(asked, "product_id", "left_semi"),
            "mentioned-items",
        )
        size = Size(*measure(items, "product_id")[:2], size.width)
    if size.rows and size.bytes <= broadcast_bytes:
        shipped = broadcast_items(items, size, "product_id")
        fitted = requests.select(key_col, *keep, clicks)
        kept = [key_col, *keep]
        return fitted.mapInArrow(_encode_batches(kept, places, shipped, score), schema)
    blocks = max(math.ceil(requests.count() / per_block), 1)
    block = F.pmod(F.xxhash64(key_col), F.lit(blocks)).cast("int").alias("_block")
    fitted = requests.select(block, key_col, *keep, clicks)
    mentioned = (
        fitted.select("_block", F.explode(mentions).alias("product_id"))
        .distinct()
        .join(items.select("product_id", "factor"), "product_id")
        .select(F.col("_block").alias("_block"), "product_id", "factor")
    )
    left = fitted.repartition(blocks, "_block").groupBy("_block")
    right = mentioned.repartition(blocks, "_block").groupBy("_block")
    kernel = _encode_block([key_col, *keep], places, size.width, score)
    return left.cogroup(right).applyInArrow(kernel, schema)


def _encode_batches(kept: list[str], weights: np.ndarray, shipped, score: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, factors = shipped.value
        for batch in batches:
            table = pa.Table.from_batches([batch])
            yield from _encode(kept, weights, table, ids, factors, score).to_batches()

    return run


def _encode_block(kept: list[str], weights: np.ndarray, width: int, score: str | None):
    def run(fitted: pa.Table, mentioned: pa.Table) -> pa.Table:
        ids, factors = mentioned["product_id"].combine_chunks(), as_matrix(mentioned["factor"])
        if not len(ids):
            factors = np.zeros((0, width))
        return _encode(kept, weights, fitted, ids, factors, score)

    return run


def _encode(
    kept: list[str], weights: np.ndarray, fitted: pa.Table, ids: pa.Array, factors, score=None
) -> pa.Table:
    columns = {c: fitted[c] for c in kept}
    if not len(ids):
        factors = np.zeros((1, factors.shape[1]))  # nothing is known; the row is never used
    at = pc.index_in(fitted["_clicks"].combine_chunks().flatten(), value_set=ids)
    known = np.asarray(pc.is_valid(at)).reshape(-1, len(weights))
    at = np.asarray(pc.fill_null(at, 0)).reshape(-1, len(weights))
    total = np.zeros((len(at), factors.shape[1]))
    for place, weight in enumerate(weights):
        total += factors[at[:, place]] * (weight * known[:, place])[:, None]
    total /= np.maximum(known.sum(axis=1), 1)[:, None]
    if score is None:
        return pa.table({**columns, "factor": as_lists(total)})
    own = pc.index_in(fitted[score].cast(ids.type).combine_chunks(), value_set=ids)
    product = np.einsum("bd,bd->b", total, factors[np.asarray(pc.fill_null(own, 0))])
    known = np.asarray(pc.is_valid(own))
    return pa.table({**columns, "score": pa.array(product, pa.float64(), mask=~known)})
