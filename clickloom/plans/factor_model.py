"""Matrix factorisation of ratings: by the built-in ALS solver, or epoch by epoch.

ALS runs a fixed number of iterations; ``train_by_rotation`` keeps an error per
epoch, stops early, goes on from a given model and resumes a run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clicks import EVENT_WEIGHTS
from clickloom.functions.vectors import dot
from clickloom.operators.indexing import dense_index
from clickloom.operators.matrix import measure
from clickloom.operators.metrics import error_metrics
from clickloom.operators.ratings import build_ratings, normalize_ratings, split
from clickloom.operators.skew import hot_keys, skew_join
from clickloom.operators.topn import top_n
from clickloom.plans import rotation
from clickloom.plans.stopping import Patience
from clickloom.session import checkpoint_root, materialize
from clickloom.sources.models import load_version, save_version

RANK = 20
EPOCHS = 20
# The solver scales the penalty by the number of ratings of a row. Chosen so that held-out
# ratings of the test tables are predicted no worse than by their mean.
REG = 0.3
MODEL_TYPE = "factor"
# Of an epoch loop.
PATIENCE, MIN_DELTA = 3, 1e-4
# In each half of an iteration the solver sends a vector to every block of the other side
# that rated it. A side's blocks follow the ratings, but are no more than lets the vectors
# sent to them be one for so many ratings, as long as a block stays small enough for
# a task's memory. Each block that only memory asks for sends the vectors once more, so past
# MIN_BLOCKS of the largest blocks the shuffle grows faster than the ratings.
RATINGS_PER_BLOCK, MOST_PER_BLOCK = 100_000, 8_000_000
RATINGS_PER_VECTOR = 10
MIN_BLOCKS, MAX_BLOCKS = 4, 2_000
# Vectors of one side that are broadcast to the pairs to predict.
SHIPPED_BYTES = 64 * 1024 * 1024


@dataclass
class FactorModel:
    """Factor tables keyed by the original ids."""

    users: DataFrame  # (user_id, factor ARRAY<DOUBLE>)
    items: DataFrame  # (product_id, factor ARRAY<DOUBLE>)
    metadata: dict = field(default_factory=dict)


@dataclass
class IndexedRatings:
    """Ratings with dense integer ids, and the ids of each key."""

    ratings: DataFrame  # (_user INT, _item INT, rating)
    users: DataFrame  # (user_id, index)
    items: DataFrame  # (product_id, index)
    user_blocks: int
    item_blocks: int


def index_ratings(ratings: DataFrame) -> IndexedRatings:
    """Prepare ratings for the solver. A product that most users rated is salted in the join.

    The ratings are scanned several times, so a costly plan should be materialized first.
    """
    rated = ratings.select("user_id", "product_id", "rating")
    users = materialize(dense_index(rated, "user_id"), "user-index")
    items = materialize(dense_index(rated, "product_id"), "item-index")
    with_user = skew_join(
        rated, users.withColumnRenamed("index", "_user"), "user_id", "inner",
        hot_keys(rated, "user_id"),
    )
    with_both = skew_join(
        with_user, items.withColumnRenamed("index", "_item"), "product_id", "inner",
        hot_keys(rated, "product_id"),
    )
    indexed = with_both.select(F.col("_user").cast("int"), F.col("_item").cast("int"), "rating")
    n_ratings = rated.count()
    user_blocks = solver_blocks(n_ratings, items.count())
    item_blocks = solver_blocks(n_ratings, users.count())
    return IndexedRatings(indexed, users, items, user_blocks, item_blocks)


def solver_blocks(n_ratings: int, vectors: int) -> int:
    """Blocks of a side, to each of which the other side may send all its ``vectors``."""
    cheap = n_ratings // (RATINGS_PER_VECTOR * max(vectors, 1))
    most = max(cheap, math.ceil(n_ratings / MOST_PER_BLOCK))
    blocks = min(math.ceil(n_ratings / RATINGS_PER_BLOCK), most)
    return min(max(MIN_BLOCKS, blocks), MAX_BLOCKS)


def train_factors(
    ratings: DataFrame | IndexedRatings,
    rank: int = RANK,
    epochs: int = EPOCHS,
    reg: float = REG,
    seed: int = 42,
) -> FactorModel:
    """Factor the ratings; unseen users and items simply have no row.

    The vectors explain what ratings differ from their mean, the model's offset.
    """
    data = ratings if isinstance(ratings, IndexedRatings) else index_ratings(ratings)
    checkpoint_root(data.ratings.sparkSession)
    mean = data.ratings.agg(F.avg("rating")).first()[0] or 0.0
    solver = ALS(
        rank=rank,
        maxIter=epochs,
        regParam=reg,
        seed=seed,
        userCol="_user",
        itemCol="_item",
        ratingCol="rating",
        numUserBlocks=data.user_blocks,
        numItemBlocks=data.item_blocks,
        coldStartStrategy="nan",
    )
    solved = solver.fit(data.ratings.withColumn("rating", F.col("rating") - F.lit(mean)))

    def named(factors: DataFrame, ids: DataFrame, key: str) -> DataFrame:
        vectors = factors.select(
            F.col("id").cast("bigint").alias("index"),
            F.col("features").cast("array<double>").alias("factor"),
        )
        return materialize(ids.join(vectors, "index").select(key, "factor"), f"{key}-factors")

    return FactorModel(
        named(solved.userFactors, data.users, "user_id"),
        named(solved.itemFactors, data.items, "product_id"),
        {"n_factors": rank, "epochs_completed": epochs, "rating_offset": mean},
    )


def predict(
    model: FactorModel,
    pairs: DataFrame,
    user_col: str = "user_id",
    item_col: str = "product_id",
    hot_users: DataFrame | None = None,
    hot_items: DataFrame | None = None,
) -> DataFrame:
    """Add ``prediction``, the offset and the vectors' product; a pair with an unseen user or
    item predicts 0.0."""
    users = model.users.withColumnRenamed("factor", "_user_factor")
    items = model.items.withColumnRenamed("factor", "_item_factor")
    users = users.withColumnRenamed("user_id", user_col)
    items = items.withColumnRenamed("product_id", item_col)
    sides = [(users, user_col, "_user_factor", hot_users), (items, item_col, "_item_factor", hot_items)]
    # What is small travels to the pairs; a large side goes first, while the pairs are narrow.
    sized = [
        (measure(rows, key, vector).bytes > SHIPPED_BYTES, rows, key, hot)
        for rows, key, vector, hot in sides
    ]
    joined = pairs
    for large, rows, key, hot in sorted(sized, key=lambda s: not s[0]):
        if large:
            joined = skew_join(joined, rows, key, "left", hot)
        else:
            joined = joined.join(F.broadcast(rows), key, "left")
    joined = joined.select(*pairs.columns, "_user_factor", "_item_factor")
    offset = F.lit(float(model.metadata.get("rating_offset") or 0.0))
    score = F.coalesce(dot(F.col("_user_factor"), F.col("_item_factor")) + offset, F.lit(0.0))
    return joined.withColumn("prediction", score).drop("_user_factor", "_item_factor")


def evaluate(model: FactorModel, test: DataFrame) -> DataFrame:
    """RMSE, MAE and size of the test rows."""
    scored = predict(
        model,
        test,
        hot_users=hot_keys(test, "user_id"),
        hot_items=hot_keys(test, "product_id"),
    )
    return error_metrics(scored)


def train_by_rotation(
    ratings: DataFrame,
    rank: int = RANK,
    epochs: int = EPOCHS,
    seed: int = 42,
    validation: DataFrame | None = None,
    check_at: Sequence[int] | None = None,
    patience: int | None = PATIENCE,
    min_delta: float = MIN_DELTA,
    start: FactorModel | None = None,
    path: str | None = None,
    center: bool = True,
    blocks: int | None = None,
    strata: int | None = None,
    **steps,
) -> FactorModel:
    """Train epoch by epoch (see ``rotation``) and return the best epoch's model.

    The error watched is that of ``validation``, after every epoch or those in
    ``check_at``, else the one met while training; the run ends when ``patience``
    looks did not find it lower by ``min_delta``. The metadata keep both per epoch.
    ``start`` is a model to go on from: known ids keep their vectors, new ones get
    first vectors, and ``epochs`` more are run. With ``path`` every epoch is saved as
    a version there, and a run that finds versions goes on behind the last one, with
    the same result as a run that was never broken off. ``center`` explains the
    ratings' differences from their mean. ``steps`` takes ``lr``, ``reg``, ``batch``.
    """
    spark = ratings.sparkSession
    rated = ratings.select("user_id", "product_id", "rating")
    saved = load_model(spark, path) if path else None
    known = saved or start
    meta = known.metadata if known else {}
    history, checked = (list(meta.get(k) or []) for k in ("history", "validation_history"))
    if known:
        offset, rank = meta.get("rating_offset") or 0.0, meta.get("n_factors") or rank
    else:
        offset = (rated.agg(F.avg("rating")).first()[0] or 0.0) if center else 0.0
    first = len((start.metadata.get("history") or []) if start else [])
    looks = None if check_at is None else {first + epoch for epoch in check_at}
    checked += [None] * (len(history) - len(checked))
    watch, best = Patience(patience, min_delta), known

    def look(epoch: int) -> bool:
        value = history[epoch - 1] if validation is None else checked[epoch - 1]
        return value is not None and watch.stops(value, epoch)

    stopped = any([look(epoch) for epoch in range(first + 1, len(history) + 1)])
    if watch.best_epoch:
        best = load_model(spark, path, epochs_completed=watch.best_epoch)
    plan = rotation.deal(rated, blocks, strata, steps.get("batch", rotation.BATCH))
    known_rows = (known.users, known.items) if known else (None, None)
    users, items = (
        materialize(rotation.with_new(rows, rated, key, rank, s), "rotation-start")
        for rows, key, s in zip(known_rows, ("user_id", "product_id"), (seed, seed + 1))
    )
    try:
        while not stopped and len(history) < first + epochs:
            epoch = len(history) + 1
            users, items, error = rotation.run_epoch(
                plan, users, items, offset, epoch, seed=seed, **steps
            )
            model = FactorModel(users, items, {"n_factors": rank, "rating_offset": offset})
            history.append(error)
            seen = validation is not None and (looks is None or epoch in looks)
            checked.append(evaluate(model, validation).first()["rmse"] if seen else None)
            model.metadata |= {
                "model_type": MODEL_TYPE,
                "rmse": checked[-1] if seen else error,
                "n_users": users.count(),
                "n_items": items.count(),
                "training_samples": plan.n_ratings,
                "epochs_completed": epoch,
                "history": list(history),
                "validation_history": list(checked),
            }
            if path:
                save_model(model, path)
            stopped = look(epoch)
            if best is None or watch.best_epoch == epoch:
                best = model
    finally:
        plan.drop()
    best = best or FactorModel(users, items, {"n_factors": rank, "rating_offset": offset})
    found = {**best.metadata, "history": history, "validation_history": checked}
    return FactorModel(best.users, best.items, found)


def training_history(model: FactorModel) -> DataFrame:
    """RMSE per epoch: met while training, and of the validation ratings if there were any."""
    history = model.metadata.get("history") or []
    checked = model.metadata.get("validation_history") or []
    rows = [
        (epoch, error, checked[epoch - 1] if epoch <= len(checked) else None)
        for epoch, error in enumerate(history, start=1)
    ]
    return model.items.sparkSession.createDataFrame(
        rows, "epoch int, rmse double, validation_rmse double"
    )


def train_with_early_stopping(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[int] = (5, 10, 15, 20),
    patience: int = 1,
    min_delta: float = MIN_DELTA,
    **params,
) -> tuple[FactorModel, list[tuple[int, float]]]:
    """Look at the validation RMSE after the epochs of ``grid``, until it stops falling.

    One run; no epoch is computed twice. Returns the best model and the (epochs,
    RMSE) history.
    """
    model = train_by_rotation(
        train,
        epochs=max(grid),
        validation=validation,
        check_at=grid,
        patience=patience,
        min_delta=min_delta,
        **params,
    )
    checked = enumerate(model.metadata["validation_history"], start=1)
    return model, [(epoch, rmse) for epoch, rmse in checked if rmse is not None]


def train_factor_model(
    events: DataFrame,
    weights=EVENT_WEIGHTS,
    normalize: bool = True,
    fraction: float = 0.8,
    seed: int = 42,
    solver: str = "als",
    **params,
) -> tuple[FactorModel, DataFrame]:
    """Events to a model with its metadata; also returns the train ratings.

    Ratings are scaled before the split, so the bounds cover all of them. ``solver``
    is ``als`` or ``rotation``; ``params`` are those of ``train_factors`` or
    ``train_by_rotation``.
    """
    solvers = {"als": train_factors, "rotation": train_by_rotation}
    if solver not in solvers:
        raise ValueError(f"unknown solver: {solver}")
    ratings = materialize(build_ratings(events, weights), "raw-ratings")
    bounds = ratings.agg(F.min("rating"), F.max("rating")).first()
    if bounds[0] is None:
        raise ValueError("no ratings in the input")
    scaled = materialize(normalize_ratings(ratings), "ratings") if normalize else ratings
    train, test = split(scaled, fraction, seed)
    model = solvers[solver](train, seed=seed, **params)
    errors = evaluate(model, test).first()
    model.metadata.update(
        model_type=MODEL_TYPE,
        rmse=errors["rmse"],
        mae=errors["mae"],
        n_users=model.users.count(),
        n_items=model.items.count(),
        training_samples=train.count(),
        test_samples=errors["n"],
        rating_min=float(bounds[0]),
        rating_max=float(bounds[1]),
        normalized=normalize,
    )
    return model, train


def recommend_top_n(
    model: FactorModel,
    users: DataFrame | None = None,
    n: int = 10,
    exclude: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Top-N items per known user; ``exclude`` holds (user, item) pairs to leave out.

    Users without a factor row get no rows.
    """
    queries = model.users
    if users is not None:
        queries = queries.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return top_n(queries, model.items, n, exclude, **options)


def sample_recommendations(
    model: FactorModel, seen: DataFrame, users: int = 3, n: int = 5
) -> DataFrame:
    """Top-N of the first few users by id, without what they rated: a glance at a model."""
    some = model.users.orderBy("user_id").limit(users)
    return recommend_top_n(model, some, n, seen.join(some, "user_id", "left_semi"))


def save_model(model: FactorModel, path: str) -> str:
    return save_version(
        model.users.sparkSession,
        path,
        {"users": model.users, "items": model.items},
        model.metadata,
        schemas.FACTOR_MODEL_METADATA,
    )


def load_model(spark: SparkSession, path: str, **wanted) -> FactorModel | None:
    """The latest version; ``wanted`` (metadata values) narrows the choice."""
    found = load_version(
        spark, path, ["users", "items"], schemas.FACTOR_MODEL_METADATA, **wanted
    )
    if found is None:
        return None
    parts, metadata = found
    return FactorModel(parts["users"], parts["items"], metadata)
