"""Event-time and date expressions. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted text forms.
LENIENT_FORM = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2}(\.\d{0,9})?)?$"
STRICT_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$"
STRICT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
NUMBER_FORM = r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$"


def parse_event_time(ts: Column, mode: str = "lenient") -> Column:
    """ISO text to TIMESTAMP.

    ``lenient`` keeps milliseconds (the first 23 characters) and takes any
    fraction; ``strict`` wants exactly six fraction digits.
    """
    if mode == "lenient":
        text = F.substring(F.replace(ts, F.lit("T"), F.lit(" ")), 1, 23)
        return F.when(text.rlike(LENIENT_FORM), text.try_cast("timestamp"))
    if mode == "strict":
        return F.when(
            ts.rlike(STRICT_FORM), F.try_to_timestamp(ts, F.lit(STRICT_PATTERN))
        )
    raise ValueError(f"unknown mode: {mode}")


def normalize_timestamp(ts: Column) -> Column:
    """ISO text or epoch seconds (as text or number) to TIMESTAMP."""
    text = F.trim(ts.cast("string"))
    micros = text.try_cast("decimal(22,6)") * F.lit(1_000_000)
    return F.when(text.rlike(NUMBER_FORM), F.timestamp_micros(micros.cast("bigint"))).otherwise(
        text.try_cast("timestamp")
    )


def with_event_order(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Add the time column in row order where a file does not carry one."""
    if time_col in df.columns:
        return df
    return df.withColumn(
        time_col, F.timestamp_micros(F.monotonically_increasing_id())
    )


def month_of(date: Column) -> Column:
    """Date to ``YYYY-MM``."""
    return F.date_format(date, "yyyy-MM")


def to_date(text: Column) -> Column:
    return text.try_cast("date")


def to_double(text: Column) -> Column:
    return text.try_cast("double")
