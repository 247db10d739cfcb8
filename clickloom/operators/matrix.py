"""Item vectors for the matrix kernels: measured first, broadcast only when small."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest item table that is shipped to every executor, where each Python worker holds
# a copy of its own. Larger ones are joined block by block instead.
BROADCAST_BYTES = 32 * 1024 * 1024


class Size(NamedTuple):
    rows: int
    bytes: int
    width: int


def measure(items: DataFrame, id_col: str, vector_col: str = "factor") -> Size:
    """Rows, exact payload bytes and vector length of an item table, from one aggregate."""
    row = items.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.size(vector_col) * 8), F.lit(0)),
        F.coalesce(F.sum(F.octet_length(F.col(id_col).cast("string")) + 8), F.lit(0)),
        F.coalesce(F.max(F.size(vector_col)), F.lit(0)),
    ).first()
    return Size(row[0], row[1] + row[2], row[3])


def small_items(
    items: DataFrame, size: Size, id_col: str, vector_col: str = "factor"
) -> tuple[pa.Array, np.ndarray]:
    """Sorted ids and the matrix of their vectors, one row per item."""
    if size.bytes > BROADCAST_BYTES:
        raise ValueError(f"{size.bytes} bytes of item vectors are too many to broadcast")
    table = items.select(id_col, F.col(vector_col).cast("array<double>")).toArrow()
    table = table.take(pc.sort_indices(table[id_col]))
    return table[id_col].combine_chunks(), as_matrix(table[vector_col])


def broadcast_items(
    items: DataFrame, size: Size, id_col: str, vector_col: str = "factor"
) -> Broadcast:
    """Ids and matrix of ``small_items``, on every executor."""
    found = small_items(items, size, id_col, vector_col)
    return items.sparkSession.sparkContext.broadcast(found)


def as_matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists to a matrix with one row per list; lists of different lengths are an error."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if not len(vectors):
        return np.empty((0, 0))
    lengths = pc.min_max(pc.list_value_length(vectors)).as_py()
    if vectors.null_count or lengths["min"] != lengths["max"]:
        raise ValueError(f"vectors differ in length: {lengths}")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def as_lists(matrix: np.ndarray) -> pa.Array:
    count, width = matrix.shape
    offsets = pa.array(np.arange(count + 1, dtype=np.int64) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.reshape(-1)))
