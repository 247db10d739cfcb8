"""Per-user click sequences.

A window over one user's whole history puts it into one task, so the history of
a hot user is cut into slices of about equal numbers of clicks first. Slices are processed like users of
their own, and the few rows at a slice edge get what they need from the
neighbouring slices: the last K-1 clicks before it and the first click after it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.clicks import PAD, last_k, pad_left
from clickloom.operators.skew import HOT_ROWS, hot_keys
from clickloom.session import materialize

SEQUENCE_LENGTH = 10
# Slices per HOT_ROWS rows of the hot users; spare ones absorb the range sort's error.
SLICES_PER_TASK = 2
# Slices that a low ``hot_rows`` asks for at most: what a range sort samples, and what its
# tasks tell the driver, grows with their number. A slice of HOT_ROWS rows is always small.
MAX_SLICES = 128


def _order(time_col: str, tie_cols: Sequence[str]) -> list[Column]:
    return [F.col(time_col).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_cols]]


def _reverse_order(time_col: str, tie_cols: Sequence[str]) -> list[Column]:
    return [F.col(time_col).desc_nulls_first(), *[F.col(c).desc_nulls_first() for c in tie_cols]]


def click_sequences(
    events: DataFrame,
    k: int = SEQUENCE_LENGTH,
    user_col: str = "user_id",
    item_col: str = "product_id",
    time_col: str = "event_time",
    tie_cols: Sequence[str] = (),
    pad: str | Column = PAD,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per click that has a next click: the last ``k`` items and the next one.

    Adds ``sequence`` (padded on the left to ``k`` items, the click itself last)
    and ``target``; ``pad`` is of the item's type. Order is time, then ``tie_cols``; a missing time sorts last.
    Rows without user or item are left out.
    """
    clicks = events.filter(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
    hot = hot_keys(clicks, user_col, min_rows=hot_rows)
    if hot is None:
        local = _with_history(clicks, k, [user_col], item_col, time_col, tie_cols)
        history, following = F.col("_history"), F.col("_next")
        joined = local
    else:
        sliced = _slice_hot_users(clicks, hot, user_col, time_col, tie_cols, hot_rows)
        local = _with_history(sliced, k, [user_col, "_slice"], item_col, time_col, tie_cols)
        edges = _slice_edges(
            sliced.filter("_hot"), k, user_col, item_col, time_col, tie_cols
        )
        joined = local.join(edges, [user_col, "_slice"], "left")
        earlier = F.coalesce(F.col("_before"), F.slice("_history", 1, 0))
        history = last_k(F.concat(earlier, F.col("_history")), k)
        following = F.coalesce(F.col("_next"), F.col("_after"))
    return (
        joined.withColumn("sequence", pad_left(history, k, pad))
        .withColumn("target", following)
        .filter(F.col("target").isNotNull())
        .select(*events.columns, "sequence", "target")
    )


def _with_history(
    df: DataFrame,
    k: int,
    partition: list[str],
    item_col: str,
    time_col: str,
    tie_cols: Sequence[str],
) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*_order(time_col, tie_cols))
    return df.withColumn(
        "_history", F.collect_list(item_col).over(w.rowsBetween(-(k - 1), 0))
    ).withColumn("_next", F.lead(item_col).over(w))


def _slice_hot_users(
    clicks: DataFrame,
    hot: DataFrame,
    user_col: str,
    time_col: str,
    tie_cols: Sequence[str],
    hot_rows: int,
) -> DataFrame:
    """Number each hot user's slices; all other users are one slice.

    Slices are the partitions of a range sort of the hot users' rows in click
    order, so they hold as many rows each however the clicks bunch in time. Clicks
    that tie in the order are told apart by their content, and those alike in every
    column (a bot without event ids) by their place in a written table: which of them
    comes first makes no difference, and a retried task numbers them the same way.
    """
    listed = F.broadcast(hot.select(user_col))
    content = F.xxhash64(*clicks.columns)
    rows = hot.agg(F.sum("hot_rows")).first()[0]
    slices = _slice_count(rows, hot_rows)
    written = materialize(clicks.join(listed, user_col, "left_semi"), "hot-rows")
    placed = written.withColumn("_place", F.monotonically_increasing_id())
    order = [F.col(user_col), *_order(time_col, tie_cols), content, F.col("_place")]
    cut = materialize(
        placed.repartitionByRange(slices, *order)
        .withColumn("_slice", F.spark_partition_id())
        .drop("_place"),
        "hot-clicks",
    )
    others = clicks.join(listed, user_col, "left_anti").withColumn("_slice", F.lit(0))
    return cut.withColumn("_hot", F.lit(True)).unionByName(
        others.withColumn("_hot", F.lit(False))
    )


def _slice_count(rows: int, hot_rows: int) -> int:
    """Slices of about ``hot_rows`` rows, as long as they are not many."""
    least = math.ceil(rows * SLICES_PER_TASK / max(hot_rows, HOT_ROWS))
    return max(least, min(math.ceil(rows * SLICES_PER_TASK / hot_rows), MAX_SLICES))


def _slice_edges(
    sliced: DataFrame,
    k: int,
    user_col: str,
    item_col: str,
    time_col: str,
    tie_cols: Sequence[str],
) -> DataFrame:
    """Per slice of a hot user: up to k items before it and the first item after it."""
    slice_cols = [user_col, "_slice"]
    backwards = Window.partitionBy(*slice_cols).orderBy(*_reverse_order(time_col, tie_cols))
    forwards = Window.partitionBy(*slice_cols).orderBy(*_order(time_col, tie_cols))
    tails = (
        sliced.withColumn("_rank", F.row_number().over(backwards))
        .filter(F.col("_rank") <= k)
        .groupBy(*slice_cols)
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct(-F.col("_rank"), F.col(item_col)))),
                lambda x: x[item_col],
            ).alias("_tail")
        )
    )
    heads = (
        sliced.withColumn("_rank", F.row_number().over(forwards))
        .filter(F.col("_rank") <= 1)
        .select(*slice_cols, F.col(item_col).alias("_head"))
    )
    by_slice = Window.partitionBy(user_col).orderBy("_slice")
    earlier = F.flatten(F.collect_list("_tail").over(by_slice.rowsBetween(-k, -1)))
    return (
        tails.join(heads, slice_cols)
        .withColumn("_before", last_k(earlier, k))
        .withColumn("_after", F.lead("_head").over(by_slice))
        .select(*slice_cols, "_before", "_after")
    )


def recent_clicks(
    events: DataFrame,
    k: int = SEQUENCE_LENGTH,
    user_col: str = "user_id",
    item_col: str = "product_id",
    time_col: str = "event_time",
    tie_cols: Sequence[str] = (),
) -> DataFrame:
    """The last ``k`` items of each user, oldest first, as one array.

    The rank filter is pushed below the shuffle, so a task sends at most ``k``
    rows per user however long a history is.
    """
    w = Window.partitionBy(user_col).orderBy(*_reverse_order(time_col, tie_cols))
    return (
        events.filter(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
        .select(user_col, F.col(item_col).alias("_item"), time_col, *tie_cols)
        .withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") <= k)
        .groupBy(user_col)
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct(-F.col("_rank"), "_item"))),
                lambda x: x["_item"],
            ).alias("click_sequence")
        )
    )
