"""Implicit ratings: weight, sum, describe, scale, split."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.clicks import EVENT_WEIGHTS, event_weight
from clickloom.session import materialize

# Distinct values of a range that one task ranks.
MEDIAN_VALUES = 1_000_000


def build_ratings(
    events: DataFrame,
    weights: Mapping[str, float] = EVENT_WEIGHTS,
    user_col: str = "user_id",
    item_col: str = "product_id",
) -> DataFrame:
    """Sum of event weights per (user, item).

    A pair with only unknown event types rates 0.0; rows without a key drop out.
    Partial aggregation folds hot pairs before the shuffle.
    """
    return (
        events.filter(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
        .groupBy(user_col, item_col)
        .agg(
            F.coalesce(F.sum(event_weight(F.col("event_type"), weights)), F.lit(0.0)).alias(
                "rating"
            )
        )
    )


def normalize_ratings(
    ratings: DataFrame, low: float = 1.0, high: float = 5.0, value_col: str = "rating"
) -> DataFrame:
    """Min-max scale to [low, high]; equal ratings all become the middle."""
    least = ratings.select(F.min(value_col)).scalar()
    most = ratings.select(F.max(value_col)).scalar()
    scaled = F.lit(low) + F.lit(high - low) * (F.col(value_col) - least) / (most - least)
    middle = F.lit((low + high) / 2.0)
    return ratings.withColumn(value_col, F.when(most > least, scaled).otherwise(middle))


def split(
    ratings: DataFrame,
    fraction: float = 0.8,
    seed: int = 42,
    keys: tuple[str, ...] = ("user_id", "product_id"),
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the keys: stable under re-runs and re-partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    in_train = draw < F.lit(round(fraction * 100))
    return ratings.filter(in_train), ratings.filter(~in_train)


def exact_median(
    df: DataFrame, value_col: str, values_per_part: int = MEDIAN_VALUES
) -> float | None:
    """Exact median without bringing the values together.

    Values are counted, which folds equal ones before the shuffle, and dealt
    into ranges of about ``values_per_part`` distinct values. The ranges' counts
    say which range holds the middle ranks; only that one is ranked.
    """
    values = df.select(F.col(value_col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counted = materialize(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "median-counts")
    total, distinct = counted.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not total:
        return None
    parts = math.ceil(distinct / values_per_part)
    ranged = materialize(
        counted.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()),
        "median-ranges",
    )
    sums = ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()

    def at(rank: int) -> float:
        below = 0
        for part, n in sums:
            if rank < below + n:
                break
            below += n
        upto = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.lit(below)
        own = ranged.where(F.col("part") == part).select("v", upto.alias("upto"))
        return own.where(F.col("upto") > rank).agg(F.min("v")).first()[0]

    first, second = (total - 1) // 2, total // 2
    low = at(first)
    return (low + (low if first == second else at(second))) / 2.0


def rating_stats(ratings: DataFrame, value_col: str = "rating") -> DataFrame:
    """Count, min, max, mean, median and sample deviation, in one row."""
    median = exact_median(ratings, value_col)
    value = F.col(value_col)
    return ratings.agg(
        F.count(value).alias("n_ratings"),
        F.min(value).alias("rating_min"),
        F.max(value).alias("rating_max"),
        F.avg(value).alias("rating_mean"),
        F.lit(median).cast("double").alias("rating_median"),
        F.stddev_samp(value).alias("rating_std"),
    )
