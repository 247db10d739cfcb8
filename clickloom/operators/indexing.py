"""Distributed dense integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def dense_index(keys: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Give each distinct value of ``key`` an id in ``0 .. n-1``.

    Values are hashed into buckets and numbered inside them, and a bucket's
    offset is the row count of the buckets before it. Only the ``buckets``
    counts meet in one task. The ids depend on the set of keys alone.
    """
    distinct = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    placed = distinct.withColumn(
        "_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select("_bucket", "_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        placed.withColumn("_rank", inside)
        .join(F.broadcast(offsets), "_bucket")
        .select(key, (F.col("_offset") + F.col("_rank") - 1).alias("index"))
    )
