"""Hot keys: find them with one pre-aggregated pass, then split their rows.

A key may hold a large share of all rows. Grouped sums and counts need nothing
special (partial aggregation folds a hot key before the shuffle); joins and
windows do, and use the helpers here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize

# Rows of one key that a single task handles comfortably.
HOT_ROWS = 1_000_000
# Hot keys that are held on the driver and broadcast; more of them stay a table.
BROADCAST_KEYS = 65_536


def hot_keys(
    df: DataFrame,
    key: str,
    *stats: Column,
    min_rows: int = HOT_ROWS,
    max_keys: int | None = None,
) -> DataFrame | None:
    """The keys with more than ``min_rows`` rows, or None when there are none.

    Reads one column (plus what ``stats`` needs). With ``max_keys`` only the heaviest
    are listed. Which keys are listed changes only how work is split, never a result.
    """
    heavy = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("hot_rows"), *stats)
        .filter(F.col("hot_rows") > min_rows)
    )
    if max_keys is not None:
        heavy = heavy.orderBy(F.col("hot_rows").desc()).limit(max_keys)
    rows = heavy.limit(BROADCAST_KEYS + 1).collect()
    if not rows:
        return None
    if len(rows) > BROADCAST_KEYS:
        return materialize(heavy, "hot-keys")
    return df.sparkSession.createDataFrame(rows, heavy.schema)


def skew_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    rows_per_task: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join where a key of ``big`` may be hot and ``small`` has few rows per key.

    Rows of a hot key get a salt hashed from their content, and the matching
    rows of ``small`` are repeated once per salt. Keys that are not hot keep
    salt 0, so without hot keys this is a plain join. ``how`` is ``inner`` or
    ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if hot is None:
        return big.join(small, key, how)
    salts = hot.select(key, F.ceil(F.col("hot_rows") / F.lit(rows_per_task)).alias("_salts"))
    if hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        salts = F.broadcast(salts)
    copies = F.coalesce(F.col("_salts"), F.lit(1))
    content = F.xxhash64(*[F.col(c) for c in big.columns])
    left = big.join(salts, key, "left").withColumn("_salt", F.pmod(content, copies))
    right = small.join(salts, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))
    )
    return left.drop("_salts").join(right.drop("_salts"), [key, "_salt"], how).drop("_salt")
