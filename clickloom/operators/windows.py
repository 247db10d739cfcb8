"""Tumbling event-time windows. The same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "10 seconds"
THRESHOLD = 5
DELAY = "5 seconds"


def fraud_windows(
    events: DataFrame,
    window: str = WINDOW,
    threshold: int = THRESHOLD,
    user_col: str = "user_id",
    time_col: str = "event_time",
    count_col: str | None = None,
) -> DataFrame:
    """Users with more than ``threshold`` events in one tumbling window.

    All rows are counted, so events without a user form a group of their own;
    with ``count_col`` only rows where that column is set count. On a stream the
    input must carry a watermark (see ``with_delay``).
    """
    counted = F.count(F.lit(1)) if count_col is None else F.count(count_col)
    return (
        events.filter(F.col(time_col).isNotNull())
        .groupBy(F.window(time_col, window), F.col(user_col))
        .agg(counted.alias("event_count"))
        .filter(F.col("event_count") > threshold)
        .select(
            F.col(user_col),
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.col("event_count"),
        )
    )


def with_delay(events: DataFrame, time_col: str = "event_time", delay: str = DELAY) -> DataFrame:
    """Bounded out-of-orderness on the event-time column."""
    return events.withWatermark(time_col, delay)
