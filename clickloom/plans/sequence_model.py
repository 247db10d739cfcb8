"""Next-click model: item vectors and position weights trained on click sequences.

The sequences are dealt to W workers once, by a seeded hash, and written as a table
with a bucket per worker; they do not move again. Every epoch a worker takes its
sequences in a new order, runs gradient steps on its own copy of the model and
returns the change of each row it touched; the new model is the old one plus the
mean change of each row. Each epoch is written to the shared folder.

If the rows that the sequences mention are few enough (measured), they are broadcast and a
worker streams through its bucket, whatever its length. With more of them a worker is a group that is joined
with just the item rows its sequences mention.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clicks import PAD
from clickloom.functions.vectors import position_weights, seeded_vector
from clickloom.operators.encoding import encode_sequences
from clickloom.operators.keys import distinct_keys, new_keys
from clickloom.operators.matrix import BROADCAST_BYTES, as_matrix, broadcast_items, measure
from clickloom.operators.sequences import SEQUENCE_LENGTH, click_sequences
from clickloom.operators.topn import top_n
from clickloom.plans.stopping import Patience
from clickloom.session import materialize, scratch_path
from clickloom.sources.files import remove_scratch
from clickloom.sources.models import load_version, save_version

FACTORS = 32
EPOCHS = 15
LEARNING_RATE = 0.01
REGULARIZATION = 0.05
PATIENCE = 3
MIN_DELTA = 1e-4
SEED = 42
INIT_SCALE = 0.1
INCREMENTAL_EPOCHS = 3
INCREMENTAL_DECAY = 0.5
# Fixed value: the type name stored with a model.
MODEL_TYPE = "prio_clicks_aware_sequence"

# Bounds that keep training stable.
FACTOR_LIMIT = 10.0
LOGIT_LIMIT = 10.0
WEIGHT_LIMITS = (0.01, 10.0)

MIN_WORKERS = 4
SEQUENCES_PER_WORKER = 100_000
BATCH = 64

CHANGES = "key long, change array<double>, loss double"


@dataclass
class SequenceModel:
    items: DataFrame  # (product_id, factor ARRAY<DOUBLE>), with the padding row
    users: DataFrame  # (user_id): users have no vector, only a count
    weights: list[float]
    metadata: dict = field(default_factory=dict)

    @property
    def n_factors(self) -> int:
        return self.metadata["n_factors"]

    @property
    def k(self) -> int:
        return len(self.weights)


def start_rows(ids: DataFrame, n_factors: int, seed: int) -> DataFrame:
    """Initial item rows; a row's values depend on its id and the seed only."""
    factor = seeded_vector(F.col("product_id"), n_factors, seed, INIT_SCALE)
    return ids.select("product_id", factor.alias("factor"))


def train_sequence_model(
    events: DataFrame,
    n_factors: int = FACTORS,
    epochs: int = EPOCHS,
    lr: float = LEARNING_RATE,
    reg: float = REGULARIZATION,
    k: int = SEQUENCE_LENGTH,
    seed: int = SEED,
    patience: int | None = PATIENCE,
    min_delta: float = MIN_DELTA,
    time_col: str = "event_time",
    tie_cols: Sequence[str] = (),
    favour: str = "oldest",
    **training,
) -> SequenceModel:
    """Train from scratch on (user_id, product_id, time) events.

    ``patience=None`` switches early stopping off. ``training`` takes
    ``workers``, ``batch`` and ``average`` (see ``_run_epochs``).
    """
    clicks = _clicks(events, time_col, tie_cols)
    padding = events.sparkSession.createDataFrame([(PAD,)], "product_id string")
    ids = distinct_keys(clicks, "product_id").unionByName(padding).distinct()
    items = start_rows(ids, n_factors, seed)
    items, weights, history = _run_epochs(
        clicks,
        items,
        position_weights(k, favour),
        n_factors,
        epochs,
        lr,
        reg,
        seed,
        time_col,
        tie_cols,
        patience,
        min_delta,
        **training,
    )
    model = SequenceModel(items, distinct_keys(clicks, "user_id"), weights)
    model.metadata = _describe(model, n_factors, history, "full", clicks.count(), lr, reg, seed)
    return model


def update_sequence_model(
    model: SequenceModel,
    new_events: DataFrame,
    epochs: int = INCREMENTAL_EPOCHS,
    decay: float = INCREMENTAL_DECAY,
    time_col: str = "event_time",
    tie_cols: Sequence[str] = (),
    **training,
) -> SequenceModel:
    """Go on training with new events only, at a decayed rate and without early stop.

    Ids the model has not seen get start rows; known rows keep their ids.
    """
    meta = model.metadata
    clicks = _clicks(new_events, time_col, tie_cols)
    seed, lr, reg = meta["seed"], meta["learning_rate"], meta["regularization"]
    added = start_rows(new_keys(clicks, model.items, "product_id"), model.n_factors, seed)
    users = model.users.unionByName(new_keys(clicks, model.users, "user_id"))
    items, weights, history = _run_epochs(
        clicks,
        model.items.select("product_id", "factor").unionByName(added),
        model.weights,
        model.n_factors,
        epochs,
        lr * decay,
        reg,
        seed,
        time_col,
        tie_cols,
        None,
        0.0,
        **training,
    )
    updated = SequenceModel(items, users, weights)
    updated.metadata = _describe(
        updated,
        model.n_factors,
        [*meta["history"], *history],
        "incremental",
        meta["total_training_samples"] + clicks.count(),
        lr,
        reg,
        seed,
    )
    return updated


def training_history(model: SequenceModel) -> DataFrame:
    """Mean loss of each epoch, incremental epochs included."""
    rows = list(enumerate(model.metadata["history"], start=1))
    return model.items.sparkSession.createDataFrame(rows, "epoch int, loss double")


def _clicks(events: DataFrame, time_col: str, tie_cols: Sequence[str]) -> DataFrame:
    return events.select(
        "user_id", F.col("product_id").cast("string").alias("product_id"), time_col, *tie_cols
    ).filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())


def _describe(model, n_factors, history, mode, samples, lr, reg, seed) -> dict:
    return {
        "model_type": MODEL_TYPE,
        "n_users": model.users.count(),
        "n_items": model.items.count(),
        "n_factors": n_factors,
        "sequence_length": model.k,
        "epochs_completed": len(history),
        "final_loss": history[-1] if history else 0.0,
        "training_mode": mode,
        "total_training_samples": samples,
        "learning_rate": lr,
        "regularization": reg,
        "seed": seed,
        "position_weights": model.weights,
        "history": history,
    }


def _keyed(items: DataFrame) -> tuple[DataFrame, int]:
    """Item rows with a 64-bit key from their id, and the salt that keeps keys distinct."""
    n_items = items.count()
    for salt in range(16):
        key = F.xxhash64("product_id", F.lit(salt))
        if items.select(key.alias("key")).distinct().count() == n_items:
            return items.withColumn("key", key), salt
    raise ValueError("item ids are not distinct")


def _run_epochs(
    clicks: DataFrame,
    items: DataFrame,
    weights: list[float],
    n_factors: int,
    epochs: int,
    lr: float,
    reg: float,
    seed: int,
    time_col: str,
    tie_cols: Sequence[str],
    patience: int | None,
    min_delta: float,
    workers: int | None = None,
    batch: int = BATCH,
    average: str = "touched",
    deal_by: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, list[float], list[float]]:
    """The epoch loop: item rows, position weights and the mean loss of each epoch.

    ``workers`` is W. By default it follows the number of sequences alone, so a
    model depends neither on the cluster nor on how items are shipped. ``deal_by``
    names an integer column among ``tie_cols`` whose remainder by W picks the worker,
    instead of a hash.
    ``average="touched"`` divides a row's summed change by the workers that touched
    it, which keeps the step size when W is large; ``"workers"`` divides by W.
    """
    spark = clicks.sparkSession
    k = len(weights)
    state_path = scratch_path(spark, "sequence-start")
    items.write.parquet(state_path)
    keyed, salt = _keyed(spark.read.parquet(state_path))

    # Items become 64-bit keys before the window, so it sorts and ships numbers.
    samples_path = scratch_path(spark, "sequences")
    coded = clicks.withColumn("product_id", F.xxhash64("product_id", F.lit(salt)))
    padding = F.xxhash64(F.lit(PAD), F.lit(salt))
    draw = F.xxhash64("user_id", time_col, *tie_cols, "target")
    picked = F.xxhash64(draw, F.lit(seed)) if deal_by is None else F.col(deal_by)
    click_sequences(coded, k, time_col=time_col, tie_cols=tie_cols, pad=padding).select(
        draw.alias("sample"), picked.cast("long").alias("draw"), "sequence", "target"
    ).write.parquet(samples_path)
    samples = spark.read.parquet(samples_path)
    n_samples = samples.count()

    # No other row changes, so only these are shipped.
    mentioned = materialize(
        samples.select(F.explode(F.array_distinct(F.concat("sequence", F.array("target")))))
        .toDF("key")
        .distinct(),
        "mentioned-keys",
    )
    size = measure(keyed.join(mentioned, "key", "left_semi"), "key")
    small = size.bytes <= broadcast_bytes
    if workers is None:
        workers = max(MIN_WORKERS, math.ceil(n_samples / SEQUENCES_PER_WORKER))
    steps = {"lr": lr, "reg": reg, "batch": batch}

    # The position weights ride along as the row without a key.
    state = keyed.select("product_id", "key", "factor").unionByName(
        spark.createDataFrame(
            [(None, None, weights)], "product_id string, key long, factor array<double>"
        )
    )
    history: list[float] = []
    watch = Patience(patience, min_delta)
    buckets_path = scratch_path(spark, "sequence-buckets")
    name = _deal(samples, workers, buckets_path)
    remove_scratch(spark, samples_path)
    for epoch in range(epochs):
        place = F.xxhash64("sample", F.lit(seed + epoch)).alias("place")
        dealt = spark.table(name).select("worker", place, "sequence", "target")
        shipped = None
        if small:
            shipped = broadcast_items(state.join(mentioned, "key", "left_semi"), size, "key")
            changes = _changes_by_bucket(dealt, shipped, weights, steps)
        else:
            changes = _changes_by_group(dealt, state, weights, steps)
        path = scratch_path(spark, f"sequence-epoch-{epoch}")
        _apply(state, changes, max(n_factors, k), workers, average).write.parquet(path)
        if shipped is not None:
            shipped.destroy()
        remove_scratch(spark, state_path)
        state, state_path = spark.read.parquet(path), path
        row = state.filter(F.col("key").isNull()).first()
        weights = list(row["factor"])
        loss = (row["loss"] or 0.0) / max(n_samples, 1)
        history.append(loss)
        state = state.select("product_id", "key", "factor")
        if watch.stops(loss, epoch):
            break
    spark.sql(f"DROP TABLE {name}")
    remove_scratch(spark, buckets_path)
    trained = state.filter(F.col("key").isNotNull()).select("product_id", "factor")
    return trained, weights, history


def _deal(samples: DataFrame, workers: int, path: str) -> str:
    """Write the samples as a table of one bucket per worker; returns its name.

    Buckets are hashed, so a worker is named by the first number that falls into the
    bucket of its own.
    """
    spark = samples.sparkSession
    numbers = spark.range(64 * workers).select(F.col("id").cast("int").alias("worker"))
    names = numbers.groupBy(F.pmod(F.hash("worker"), F.lit(workers)).alias("_bucket")).agg(
        F.min("worker").alias("worker")
    )
    picked = F.pmod("draw", F.lit(workers)).cast("int")
    dealt = samples.join(F.broadcast(names), picked == F.col("_bucket"))
    name = f"clickloom_sequences_{uuid.uuid4().hex}"
    columns = dealt.select("worker", "sample", "sequence", "target").repartition(workers, "worker")
    writer = columns.write.bucketBy(workers, "worker").option("path", path)
    writer.saveAsTable(name)
    return name


def _changes_by_bucket(
    dealt: DataFrame, shipped: Broadcast, weights: list[float], steps: dict
) -> DataFrame:
    placed = dealt.sortWithinPartitions("worker", "place").groupBy("worker")
    return placed.applyInArrow(_bucket_worker(shipped, np.array(weights), steps), CHANGES)


def _changes_by_group(
    dealt: DataFrame, state: DataFrame, weights: list[float], steps: dict
) -> DataFrame:
    mentioned = F.array_distinct(F.concat("sequence", F.array("target")))
    needed = (
        dealt.select("worker", F.explode(mentioned).alias("key"))
        .distinct()
        .join(state.select("key", "factor"), "key")
        .select(F.col("worker").alias("worker"), "key", "factor")
    )
    left, right = dealt.groupBy("worker"), needed.groupBy("worker")
    return left.cogroup(right).applyInArrow(_group_worker(np.array(weights), steps), CHANGES)


def _apply(
    state: DataFrame, changes: DataFrame, width: int, workers: int, average: str
) -> DataFrame:
    """Add the averaged changes to the rows they belong to."""
    total = ", ".join(f"sum(get(change, {i}))" for i in range(width))
    summed = changes.groupBy(F.col("key").alias("_key")).agg(
        F.expr(f"array({total})").alias("_change"),
        F.sum("loss").alias("loss"),
        F.count(F.lit(1)).alias("_touched"),
    )
    divisor = F.lit(workers) if average == "workers" else F.col("_touched")
    change = F.slice("_change", 1, F.size("factor"))
    moved = F.zip_with("factor", change, lambda x, d: x + d / divisor)
    factor = F.when(F.col("_touched").isNotNull(), moved).otherwise(F.col("factor"))
    return (
        state.join(summed, F.col("key").eqNullSafe(F.col("_key")), "left")
        .withColumn("factor", factor)
        .select("product_id", "key", "factor", "loss")
    )


def _bucket_worker(shipped: Broadcast, weights: np.ndarray, steps: dict):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, start = shipped.value
        keys = keys.to_numpy()
        factors, moved, total = start.copy(), weights, 0.0
        touched = np.zeros(len(keys), dtype=bool)
        for dealt in batches:
            rows, known, goal = _samples(dealt["sequence"], dealt["target"], keys, len(weights))
            factors, moved, loss = sgd(factors, moved, rows, known, goal, **steps)
            touched[rows[known]] = True
            touched[goal] = True
            total += loss
        result = _changes(keys, start, factors, weights, moved, np.nonzero(touched)[0], total)
        yield from result.to_batches()

    return train


def _group_worker(weights: np.ndarray, steps: dict):
    def train(dealt: pa.Table, needed: pa.Table) -> pa.Table:
        dealt = dealt.sort_by("place")
        needed = needed.sort_by("key")
        keys, start = needed["key"].to_numpy(), as_matrix(needed["factor"])
        rows, known, goal = _samples(
            dealt["sequence"].combine_chunks(), dealt["target"], keys, len(weights)
        )
        factors, moved, loss = sgd(start.copy(), weights, rows, known, goal, **steps)
        touched = np.unique(np.concatenate([rows[known], goal]))
        return _changes(keys, start, factors, weights, moved, touched, loss)

    return train


def _samples(sequence: pa.Array, target, keys: np.ndarray, k: int):
    """Row numbers of the items of each sequence; sequences with an unknown target drop out."""
    flat = sequence.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
    rows, known = _rows_of(keys, flat)
    goal, trainable = _rows_of(keys, target.to_numpy())
    return rows[trainable], known[trainable], goal[trainable]


def _changes(keys, start, factors, weights, moved, touched, loss) -> pa.Table:
    """One row per touched item, and one without a key for the weights and the loss."""
    rows = [*(factors[touched] - start[touched]), moved - weights]
    return pa.table(
        {
            "key": pa.array([*keys[touched].tolist(), None], pa.int64()),
            "change": pa.array(rows, pa.list_(pa.float64())),
            "loss": pa.array([None] * len(touched) + [loss], pa.float64()),
        }
    )


def _rows_of(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(wanted.shape, dtype=np.int64), np.zeros(wanted.shape, dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def sgd(factors, weights, rows, known, goal, lr, reg, batch):
    """Gradient steps over small batches, in the given order; changes ``factors`` in place.

    Inside a batch all samples see the same vectors. The target moves first and
    the item step uses its new value; each use of a row or weight shrinks it by
    ``1 - lr * reg``, so repeated uses compound as single steps would.
    """
    total = 0.0
    keep = 1.0 - lr * reg
    for begin in range(0, len(goal), batch):
        r, t = rows[begin : begin + batch], goal[begin : begin + batch]
        mask = known[begin : begin + batch].astype(float)
        valid = np.maximum(mask.sum(axis=1), 1.0)
        vectors = factors[r] * mask[:, :, None]
        encoded = np.einsum("k,bkd->bd", weights, vectors) / valid[:, None]
        goals = factors[t]
        logit = np.clip(np.einsum("bd,bd->b", encoded, goals), -LOGIT_LIMIT, LOGIT_LIMIT)
        chance = 1.0 / (1.0 + np.exp(-logit))
        total += -np.log(np.maximum(chance, 1e-10)).sum()
        pull = (1.0 - chance) * chance * (1.0 - chance)

        _move(factors, t, pull[:, None] * encoded * lr, keep)
        goals = factors[t]
        step = (pull / valid)[:, None] * goals * lr
        item_steps = step[:, None, :] * weights[None, :, None]
        used = mask > 0
        _move(factors, r[used], item_steps[used], keep)

        match = np.einsum("bkd,bd->bk", factors[r], goals) * mask
        gain = ((pull / valid)[:, None] * match).sum(axis=0)
        weights = weights * keep ** used.sum(axis=0) + lr * gain
        weights = np.clip(weights, *WEIGHT_LIMITS)
    return factors, weights, float(total)


def _move(factors: np.ndarray, rows: np.ndarray, steps: np.ndarray, keep: float) -> None:
    """Add the steps of equal rows together, shrink the rows and bound them."""
    if not len(rows):
        return
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    touched, uses = ordered[first], np.diff(first, append=len(ordered))
    summed = np.add.reduceat(steps[order], first, axis=0)
    moved = factors[touched] * (keep**uses)[:, None] + summed
    factors[touched] = np.clip(moved, -FACTOR_LIMIT, FACTOR_LIMIT)


def offered(model: SequenceModel) -> DataFrame:
    """The items that may be recommended: all but the padding row."""
    return model.items.filter(F.col("product_id") != PAD)


def recommend_from_sequence(
    model: SequenceModel,
    requests: DataFrame,
    n: int = 10,
    exclude: DataFrame | None = None,
    key_col: str = "request_id",
    seq_col: str = "click_sequence",
    n_col: str | None = None,
    **options,
) -> DataFrame:
    """Top-N next items per click sequence; the padding row is never offered."""
    queries = encode_sequences(requests, model.items, model.weights, key_col, seq_col)
    if n_col is not None:
        queries = queries.join(requests.select(key_col, n_col), key_col)
    count = requests.count() if exclude is not None else None
    return top_n(
        queries,
        offered(model),
        n,
        exclude,
        query_col=key_col,
        n_col=n_col,
        n_queries=count,
        **options,
    )


def save_model(model: SequenceModel, path: str) -> str:
    return save_version(
        model.items.sparkSession,
        path,
        {"items": model.items, "users": model.users},
        model.metadata,
        schemas.SEQUENCE_MODEL_METADATA,
    )


def load_model(spark: SparkSession, path: str) -> SequenceModel | None:
    found = load_version(spark, path, ["items", "users"], schemas.SEQUENCE_MODEL_METADATA)
    if found is None:
        return None
    parts, metadata = found
    return SequenceModel(
        parts["items"], parts["users"], list(metadata["position_weights"]), metadata
    )
