"""Joins, set operations and lookups on keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude_fraud(users: DataFrame, fraud: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Users whose id is not among the flagged ids.

    A user without an id stays unless the flagged set holds a missing id too.
    No join hint: the flagged set has no size bound, so the side to broadcast is
    left to the runtime statistics.
    """
    flagged = fraud.select(F.col(user_col).alias("_flagged")).distinct()
    return users.join(flagged, F.col(user_col).eqNullSafe(F.col("_flagged")), "left_anti")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def new_keys(fresh: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``fresh`` that ``known`` does not have."""
    return distinct_keys(fresh, key).join(distinct_keys(known, key), key, "left_anti")


def append(old: DataFrame, *more: DataFrame) -> DataFrame:
    """UNION ALL by column name; a missing column is NULL."""
    for df in more:
        old = old.unionByName(df, allowMissingColumns=True)
    return old


def count_distinct(df: DataFrame, *cols: str, approximate: bool = False) -> DataFrame:
    """Rows and distinct values per column, in one row."""

    def count_of(name: str) -> Column:
        return F.approx_count_distinct(name) if approximate else F.count_distinct(name)

    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[count_of(name).alias(f"n_{name}") for name in cols],
    )
