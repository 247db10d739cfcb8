"""Factor training in epochs that can be watched, stopped and resumed.

Users are hashed into blocks and items into strata. A step pairs every user block
with one stratum of items, the pairs move on by one in the next step, and after as
many steps as there are strata each rating was used once: an epoch. Within a step
no two blocks share a user, so a task updates its users freely; where several
blocks work on a stratum, an item's changes are averaged over the blocks that
touched it (with as many blocks as strata there is just one).

Ratings are written once, a folder per step, bucketed by user block, and never
move again; a step ships the vectors of its users and the items they rated. The
state after each step is a table, so a lost executor costs a re-read, and after
each epoch it can be saved as a model version from which a later run goes on.

A batch that holds all ratings is one gradient step per user block: all its ratings
see the same vectors, so a block is cut into parts whose gradients are summed, and
no task holds more than a part.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.vectors import seeded_vector
from clickloom.operators.matrix import as_lists, as_matrix
from clickloom.session import materialize, scratch_path

LEARNING_RATE = 0.02
REGULARIZATION = 0.05
INIT_SCALE = 0.1
# Bounds of an error and of a vector's entries.
ERROR_LIMIT = FACTOR_LIMIT = 10.0
# Ratings of one user block; steps of an epoch; ratings of one gradient step.
RATINGS_PER_BLOCK = 500_000
STRATA = 8
BATCH = 4096
# Of a step over all ratings at once: ratings of one part, and of one matrix product.
RATINGS_PER_PART = 100_000
CHUNK = 8192


@dataclass
class Plan:
    """Ratings as a bucketed table, and how they are dealt."""

    spark: SparkSession
    name: str
    blocks: int
    strata: int
    n_ratings: int
    parts: int = 0  # of all blocks, for steps over all ratings; 0: a block takes many batches

    def step(self, number: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("_step") == number).drop("_step")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deal(
    ratings: DataFrame, blocks: int | None = None, strata: int | None = None, batch: int = 0
) -> Plan:
    """Write (user_id, product_id, rating) by step and user block.

    A pair may occur once only. A user block's step holds at most its users times
    its stratum's items, however popular one of either is. With a ``batch`` of all
    ratings, if they are many, the table is dealt to the parts of the blocks.
    """
    spark = ratings.sparkSession
    rated = ratings.select("user_id", "product_id", F.col("rating").cast("double")).dropna()
    n_ratings = rated.count()
    blocks = blocks or max(1, math.ceil(n_ratings / RATINGS_PER_BLOCK))
    strata = min(strata or STRATA, blocks)
    blocks = math.ceil(blocks / strata) * strata
    block = F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int")
    stratum = F.pmod(F.xxhash64("product_id", F.lit(1)), F.lit(strata)).cast("int")
    dealt = rated.withColumn("_block", block).withColumn(
        "_step", F.pmod(stratum - F.col("_block"), F.lit(strata))
    )
    dealt = dealt.withColumn("_place", F.xxhash64("user_id", "product_id", F.lit(2)))
    key, buckets, parts = "_block", blocks, 0
    if batch >= n_ratings > RATINGS_PER_PART:
        cuts = math.ceil(n_ratings / (RATINGS_PER_PART * blocks))
        cut = F.pmod(F.xxhash64("user_id", F.lit(3)), F.lit(cuts)).cast("int")
        dealt = dealt.withColumn("_part", cut * blocks + F.col("_block")).drop("_place")
        key, buckets, parts = "_part", cuts * blocks, cuts * blocks
    name = f"clickloom_ratings_{uuid.uuid4().hex}"
    writer = dealt.repartition(buckets, key).write.partitionBy("_step")
    writer = writer.bucketBy(buckets, key).option("path", scratch_path(spark, "dealt-ratings"))
    writer.saveAsTable(name)
    return Plan(spark, name, blocks, strata, n_ratings, parts)


def start_vectors(ids: DataFrame, key: str, rank: int, seed: int) -> DataFrame:
    """First vectors of the distinct ids; they depend on id and seed only."""
    factor = seeded_vector(F.col(key).cast("string"), rank, seed, INIT_SCALE)
    return ids.select(key).dropna().distinct().select(key, factor.alias("factor"))


def with_new(known: DataFrame | None, ids: DataFrame, key: str, rank: int, seed: int) -> DataFrame:
    """``known`` vectors, and first ones for the ids that have none."""
    start = start_vectors(ids, key, rank, seed)
    if known is None:
        return start
    known = known.select(key, F.col("factor").cast("array<double>").alias("factor"))
    return known.unionByName(start.join(known, key, "left_anti"))


def run_epoch(
    plan: Plan,
    users: DataFrame,
    items: DataFrame,
    offset: float,
    epoch: int,
    lr: float = LEARNING_RATE,
    reg: float = REGULARIZATION,
    batch: int = BATCH,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, float]:
    """One pass over all ratings: the users' and items' new vectors, and the RMSE met on the way.

    The error of a rating is taken right before its step.
    """
    squares = 0.0
    for step in range(plan.strata):
        if plan.parts:
            moved = _run_whole_step(plan, plan.step(step), users, items, offset, lr, reg)
        else:
            kernel = _kernel(offset, lr, reg, batch, seed + epoch)
            moved = _run_step(plan, plan.step(step), users, items, kernel)
        users, items, added = moved
        squares += added
    return users, items, math.sqrt(squares / max(plan.n_ratings, 1))


def _run_step(plan: Plan, rated: DataFrame, users: DataFrame, items: DataFrame, kernel):
    user, item = (f.schema[k] for f, k in ((users, "user_id"), (items, "product_id")))
    factor = T.StructField("factor", T.ArrayType(T.DoubleType()))
    found = T.StructType([user, item, factor, T.StructField("squares", T.DoubleType())])
    own = users.select(
        F.pmod(F.xxhash64("user_id"), F.lit(plan.blocks)).cast("int").alias("_block"),
        "user_id",
        F.lit(None).cast(item.dataType).alias("product_id"),
        "factor",
    )
    # A bucket holds all of a block, so its distinct items are found without a shuffle.
    needed = rated.select("_block", "product_id").distinct().join(items, "product_id")
    needed = needed.select(
        "_block", F.lit(None).cast(user.dataType).alias("user_id"), "product_id", "factor"
    )
    left = rated.groupBy("_block")
    right = own.unionByName(needed).groupBy("_block")
    out = materialize(left.cogroup(right).applyInArrow(kernel, found), "rotation-step")
    changes = out.where("product_id IS NOT NULL")
    moved = materialize(_averaged(items, changes, "product_id"), "rotation-items")
    squares = out.agg(F.coalesce(F.sum("squares"), F.lit(0.0))).first()[0]
    return out.where("user_id IS NOT NULL").select("user_id", "factor"), moved, squares


def _run_whole_step(
    plan: Plan, rated: DataFrame, users: DataFrame, items: DataFrame, offset: float, lr: float,
    reg: float,
):
    """A step in which all ratings of a block are one batch: sums per part, then one move per row."""
    sides = {"user_id": users, "product_id": items}
    blank = {k: F.lit(None).cast(rows.schema[k].dataType) for k, rows in sides.items()}
    found = T.StructType(
        [
            T.StructField("_block", T.IntegerType()),
            *[rows.schema[k] for k, rows in sides.items()],
            T.StructField("gradients", T.ArrayType(T.DoubleType())),
            T.StructField("uses", T.LongType()),
            T.StructField("squares", T.DoubleType()),
        ]
    )
    needed = [
        rated.select("_part", k).distinct().join(rows, k)
        .select(
            F.col("_part").alias("_part"),
            *[(F.col(c) if c == k else blank[c]).alias(c) for c in sides],
            "factor",
        )
        for k, rows in sides.items()
    ]
    left, right = rated.groupBy("_part"), needed[0].unionByName(needed[1]).groupBy("_part")
    kernel = _sums_kernel(plan.blocks, offset, reg)
    sums = materialize(left.cogroup(right).applyInArrow(kernel, found), "rotation-sums")
    moved = []
    for k, rows in sides.items():
        width = rows.agg(F.coalesce(F.max(F.size("factor")), F.lit(0))).first()[0]
        total = ", ".join(f"sum(get(gradients, {i}))" for i in range(width))
        summed = (
            sums.where(F.col(k).isNotNull())
            .groupBy("_block", k)
            .agg(F.expr(f"array({total})").alias("_sums"), F.sum("uses").alias("_uses"))
        )
        rate = (1.0 - F.pow(F.lit(1.0 - lr), F.col("_uses"))) / F.col("_uses")
        limit = F.lit(FACTOR_LIMIT)
        change = F.zip_with(
            "factor", "_sums", lambda x, g: F.greatest(-limit, F.least(limit, x + rate * g)) - x
        )
        changes = summed.join(rows, k).select(k, change.alias("factor"))
        moved.append(materialize(_averaged(rows, changes, k), f"rotation-{k}"))
    squares = sums.agg(F.coalesce(F.sum("squares"), F.lit(0.0))).first()[0]
    return *moved, squares


def _averaged(items: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Add to each item the mean of its changes."""
    width = items.agg(F.coalesce(F.max(F.size("factor")), F.lit(0))).first()[0]
    means = ", ".join(f"avg(get(factor, {i}))" for i in range(width))
    summed = changes.groupBy(F.col(key).alias("_key")).agg(F.expr(f"array({means})").alias("_mean"))
    moved = F.zip_with("factor", "_mean", lambda x, d: x + d)
    factor = F.when(F.col("_mean").isNull(), F.col("factor")).otherwise(moved)
    return items.join(summed, F.col(key) == F.col("_key"), "left").select(
        key, factor.alias("factor")
    )


def _kernel(offset: float, lr: float, reg: float, batch: int, seed: int):
    def train(rated: pa.Table, state: pa.Table) -> pa.Table:
        is_user = pc.is_valid(state["user_id"])
        users, items = state.filter(is_user), state.filter(pc.invert(is_user))
        p, q = as_matrix(users["factor"]).copy(), as_matrix(items["factor"])
        moved = q.copy()
        order = np.argsort(_shuffled(rated["_place"].to_numpy(), seed), kind="stable")
        rated = rated.take(pa.array(order))
        u, i = (
            pc.index_in(rated[k], value_set=s[k].combine_chunks()).to_numpy()
            for k, s in (("user_id", users), ("product_id", items))
        )
        squares = 0.0
        if len(order):
            goals = rated["rating"].to_numpy() - offset
            squares = sgd(p, moved, u, i, goals, lr, reg, batch)
        found = [as_lists(m) for m in (p, moved - q) if len(m)]
        ids = [table[k].combine_chunks() for k, table in (("user_id", users), ("product_id", items))]
        blank = [pa.nulls(len(items) + 1, ids[0].type), pa.nulls(len(users), ids[1].type)]
        return pa.table(
            {
                "user_id": pa.concat_arrays([ids[0], blank[0]]),
                "product_id": pa.concat_arrays([blank[1], ids[1], pa.nulls(1, ids[1].type)]),
                "factor": pa.concat_arrays([*found, pa.nulls(1, pa.list_(pa.float64()))]),
                "squares": pa.array([None] * (len(users) + len(items)) + [squares], pa.float64()),
            }
        )

    return train


def _sums_kernel(blocks: int, offset: float, reg: float):
    """Sums of the gradients per row that the ratings of a part mention, at the given vectors."""

    def add(rated: pa.Table, state: pa.Table) -> pa.Table:
        is_user = pc.is_valid(state["user_id"])
        sides = {"user_id": state.filter(is_user), "product_id": state.filter(pc.invert(is_user))}
        ids = {k: s[k].combine_chunks() for k, s in sides.items()}
        p, q = (as_matrix(s["factor"]) for s in sides.values())
        u, i = (pc.index_in(rated[k], value_set=ids[k]).to_numpy() for k in sides)
        goals = rated["rating"].to_numpy() - offset
        sums, squares = (np.zeros_like(p), np.zeros_like(q)), 0.0
        for at in range(0, len(goals), CHUNK):
            rows, columns = u[at : at + CHUNK], i[at : at + CHUNK]
            old_p, old_q = p[rows], q[columns]
            errors = goals[at : at + CHUNK] - np.einsum("bd,bd->b", old_p, old_q)
            errors = np.clip(errors, -ERROR_LIMIT, ERROR_LIMIT)
            squares += float(errors @ errors)
            _add(sums[0], rows, errors[:, None] * old_q - reg * old_p)
            _add(sums[1], columns, errors[:, None] * old_p - reg * old_q)
        uses = [np.bincount(x, minlength=len(m)) for x, m in zip((u, i), (p, q))]
        blank = [pa.nulls(len(q), ids["user_id"].type), pa.nulls(len(p), ids["product_id"].type)]
        count = len(p) + len(q)
        block = rated["_part"][0].as_py() % blocks if len(rated) else 0
        return pa.table(
            {
                "_block": pa.array(np.full(count, block, "int32")),
                "user_id": pa.concat_arrays([ids["user_id"], blank[0]]),
                "product_id": pa.concat_arrays([blank[1], ids["product_id"]]),
                "gradients": pa.concat_arrays([as_lists(m) for m in sums]),
                "uses": pa.array(np.concatenate(uses).astype("int64")),
                "squares": pa.array(np.where(np.arange(count) == 0, squares, 0.0)),
            }
        )

    return add


def _add(sums: np.ndarray, rows: np.ndarray, gradients: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    sums[ordered[first]] += np.add.reduceat(gradients[order], first, axis=0)


def _shuffled(places: np.ndarray, seed: int) -> np.ndarray:
    """Another order of the same places for every seed."""
    x = (places.view("u8") + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def sgd(p, q, u, i, goals, lr: float, reg: float, batch: int) -> float:
    """Gradient steps over batches in the given order; changes ``p`` and ``q`` in place.

    Inside a batch all ratings see the same vectors. A row that occurs c times moves
    by its mean gradient times 1 - (1 - lr)^c, what c single steps towards one goal
    add up to, so a popular row cannot overshoot. Returns the sum of squared errors.
    """
    total = 0.0
    for at in range(0, len(goals), batch):
        rows, columns = u[at : at + batch], i[at : at + batch]
        old_p, old_q = p[rows], q[columns]
        errors = goals[at : at + batch] - np.einsum("bd,bd->b", old_p, old_q)
        errors = np.clip(errors, -ERROR_LIMIT, ERROR_LIMIT)
        total += float(errors @ errors)
        _move(p, rows, errors[:, None] * old_q - reg * old_p, lr)
        _move(q, columns, errors[:, None] * old_p - reg * old_q, lr)
    return total


def _move(factors: np.ndarray, rows: np.ndarray, gradients: np.ndarray, lr: float) -> None:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    uses = np.diff(first, append=len(ordered))
    mean = np.add.reduceat(gradients[order], first, axis=0) / uses[:, None]
    rate = 1.0 - (1.0 - lr) ** uses
    moved = factors[ordered[first]] + rate[:, None] * mean
    factors[ordered[first]] = np.clip(moved, -FACTOR_LIMIT, FACTOR_LIMIT)
