import json
import os

import numpy as np
import pytest
from helpers import at, events_of, random_events
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clicks import PAD
from clickloom.functions.vectors import position_weights
from clickloom.plans import factor_model, recommend, retraining
from clickloom.plans import sequence_model as seq
from clickloom.plans.factor_model import FactorModel
from clickloom.sources.models import model_info, model_versions


@pytest.fixture(scope="module")
def trained(spark):
    """Two groups of users that like two groups of items."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(3000):
        user, item = int(rng.integers(40)), int(rng.integers(30))
        liked = user % 2 == item % 2
        kind = rng.choice(["purchase", "add_to_cart"]) if liked else "payment_failed"
        rows.append((i, f"u{user}", f"p{item}", str(kind), i))
    events = events_of(spark, rows)
    return factor_model.train_factor_model(events, epochs=8, rank=6)


def test_factor_model_beats_the_mean(trained):
    model, train = trained
    mean = train.agg(F.stddev_samp("rating")).first()[0]
    assert model.metadata["rmse"] < 0.9 * mean
    assert model.metadata["mae"] <= model.metadata["rmse"]
    assert (model.metadata["n_users"], model.metadata["n_items"]) == (40, 30)
    assert model.metadata["training_samples"] == train.count()
    assert model.users.select(F.size("factor")).distinct().collect() == [(6,)]


def test_top_n_leaves_out_what_was_rated(trained):
    model, train = trained
    seen = train.select("user_id", "product_id")
    rows = factor_model.recommend_top_n(model, n=5, exclude=seen)
    assert rows.join(seen, ["user_id", "product_id"]).count() == 0
    assert rows.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5
    everything = factor_model.recommend_top_n(model, n=100)
    assert everything.count() == 40 * 30
    assert {r.user_id for r in factor_model.sample_recommendations(model, seen).collect()} <= {
        "u0", "u1", "u10"
    }


def test_unseen_predicts_zero_and_gets_no_list(spark, trained):
    model, _ = trained
    pairs = spark.createDataFrame(
        [("u1", "p1"), ("nobody", "p1"), ("u1", "nothing")], "user_id string, product_id string"
    )
    rows = {(r.user_id, r.product_id): r.prediction for r in factor_model.predict(model, pairs).collect()}
    assert rows[("nobody", "p1")] == rows[("u1", "nothing")] == 0.0
    user = model.users.filter("user_id = 'u1'").first().factor
    item = model.items.filter("product_id = 'p1'").first().factor
    offset = model.metadata["rating_offset"]
    assert rows[("u1", "p1")] == pytest.approx(offset + np.dot(user, item))
    stranger = spark.createDataFrame([("nobody",)], "user_id string")
    assert factor_model.recommend_top_n(model, stranger).count() == 0


def test_early_stopping(spark):
    events, _ = random_events(spark, 1500, 30, 30, hot_share=0.0)
    rated = factor_model.normalize_ratings(factor_model.build_ratings(events))
    train, test = factor_model.split(rated)
    model, history = factor_model.train_with_early_stopping(
        train, test, grid=(1, 2, 3), min_delta=10.0, rank=3
    )
    assert [e for e, _ in history] == [1, 2] and model.metadata["epochs_completed"] == 1


def test_save_load_and_versions(spark, trained, folder):
    model, _ = trained
    path = f"{folder}/model"
    assert factor_model.load_model(spark, path) is None
    factor_model.save_model(model, path)
    newer = FactorModel(model.users, model.items.limit(3), {**model.metadata, "n_items": 3})
    factor_model.save_model(newer, path)
    loaded = factor_model.load_model(spark, path)
    assert loaded.items.count() == loaded.metadata["n_items"] == 3
    assert model_versions(spark, path, schemas.FACTOR_MODEL_METADATA).count() == 2
    assert model_info(spark, path, schemas.FACTOR_MODEL_METADATA).count() == 1


def test_event_recommendations(spark, trained):
    model, _ = trained
    events = events_of(
        spark, [(1, "u1", "p1", "view", 1), (2, "u1", "p3", "view", 2), (3, "x", "p1", "view", 3),
                (4, "u2", None, "view", 4)]
    )
    rows = recommend.event_recommendations(events, model, n=5, keep=("event_id",)).collect()
    by_event = {}
    for r in rows:
        by_event.setdefault(r.event_id, []).append(r)
    assert {k: len(v) for k, v in by_event.items()} == {1: 5, 2: 5, 4: 5}
    assert all(r.recommended_product_id != r.product_id for r in rows)


def test_event_recommendations_with_hot_users(spark, trained):
    from clickloom.operators.skew import hot_keys

    model, _ = trained
    events = events_of(spark, [(i, f"u{i % 3}", f"p{i % 30}", "view", i) for i in range(300)])
    lists = recommend.user_lists(model)
    plain = recommend.lateral_recommend(events, lists, keep=("event_id",))
    hot = hot_keys(events, "user_id", min_rows=50)
    salted = recommend.lateral_recommend(events, lists, keep=("event_id",), hot_users=hot)
    assert sorted(plain.collect()) == sorted(salted.collect())


def test_serve_batch_edges(spark, trained):
    model, _ = trained
    everything = [f"p{i}" for i in range(30)]
    requests = spark.createDataFrame(
        [
            (1, None, 5, None, None), (2, "", 5, None, None), (3, "nobody", 5, None, None),
            (4, "u1", None, ["p1"], None), (5, "u1", 2, None, None),
            (6, "u1", 5, everything, None), (7, "u1", 99, None, None),
        ],
        schemas.REQUESTS,
    )
    rows = {r.request_id: r for r in recommend.serve_batch(requests, model).collect()}
    for bad in (1, 2):
        assert rows[bad].error == "user_id is required"
        assert rows[bad].recommendations is None and rows[bad].metadata is None
    assert rows[3].recommendations == [] and rows[3].error is None
    assert len(rows[4].recommendations) == 5
    assert "p1" not in [x.product_id for x in rows[4].recommendations]
    assert len(rows[5].recommendations) == 2
    assert rows[6].recommendations == []
    scores = [x.score for x in rows[7].recommendations]
    assert len(scores) == 30 and scores == sorted(scores, reverse=True)
    assert rows[7].metadata.n_items == 30 and rows[7].metadata.model_rmse == model.metadata["rmse"]


# --- sequence model -----------------------------------------------------------


def chain_events(spark, users=30, length=40, items=6, offset=0, prefix="p"):
    """Every user walks the same ring of items."""
    rows = []
    for u in range(users):
        for i in range(length):
            rows.append((u * length + i, f"u{u + offset}", f"{prefix}{(u + i) % items}", "view", i))
    return events_of(spark, rows)


def miss(factors, weights, rows, goal):
    """Half the squared probability of missing the target: what a step goes down on."""
    logit = (weights[:, None] * factors[rows]).sum(0) @ factors[goal] / len(rows)
    return 0.5 * (1 - 1 / (1 + np.exp(-logit))) ** 2


def one_step(factors, weights, rows, goal, lr, reg, batch=1):
    rows, goal = np.atleast_2d(rows), np.atleast_1d(goal)
    known = np.ones(rows.shape, dtype=bool)
    return seq.sgd(factors.copy(), weights.copy(), rows, known, goal, lr, reg, batch)


def test_a_step_follows_the_gradient():
    rng = np.random.default_rng(1)
    start, weights = 0.5 * rng.standard_normal((6, 5)), np.array(position_weights(4))
    rows, goal, lr, h = np.array([0, 1, 2, 3]), 4, 0.1, 1e-6
    moved, weights_after, loss = one_step(start, weights, rows, goal, lr, 0.0)
    slope = np.empty(5)
    for d in range(5):
        up, down = start.copy(), start.copy()
        up[goal, d] += h
        down[goal, d] -= h
        slope[d] = (miss(up, weights, rows, goal) - miss(down, weights, rows, goal)) / (2 * h)
    assert np.allclose(moved[goal], start[goal] - lr * slope, atol=1e-8)
    # Items move along the target's new vector, in proportion to their place's weight.
    along = (moved - start)[rows] / weights[:, None]
    assert np.allclose(along, along[0]) and np.allclose(np.cross(along[0][:3], moved[goal][:3]), 0)
    assert np.allclose(moved[5], start[5])
    assert loss == pytest.approx(-np.log(1 - np.sqrt(2 * miss(start, weights, rows, goal))))
    assert (weights_after != weights).all()


def test_steps_without_pull_only_shrink():
    """A certain hit leaves the regularisation: each use of a row counts once."""
    start = np.full((3, 2), 5.0)
    weights, lr, reg = np.array(position_weights(3)), 0.1, 0.5
    moved, weights_after, _ = one_step(start, weights, [0, 0, 1], 2, lr, reg)
    keep = 1 - lr * reg
    assert np.allclose(moved, start * np.array([[keep**2], [keep], [keep]]), atol=1e-4)
    assert np.allclose(weights_after, weights * keep, atol=1e-4)


def test_samples_of_a_batch_that_share_nothing_add_up():
    rng = np.random.default_rng(3)
    start, weights = 0.5 * rng.standard_normal((8, 4)), np.array(position_weights(3))
    rows, goal = np.array([[0, 1, 2], [4, 5, 6]]), np.array([3, 7])
    both = one_step(start, weights, rows, goal, 0.1, 0.0, batch=2)
    parts = [one_step(start, weights, r, g, 0.1, 0.0) for r, g in zip(rows, goal, strict=True)]
    assert np.allclose(both[0] - start, sum(p[0] - start for p in parts))
    assert np.allclose(both[1] - weights, sum(p[1] - weights for p in parts))
    assert both[2] == pytest.approx(sum(p[2] for p in parts))


def test_steps_stay_bounded():
    rng = np.random.default_rng(2)
    start, weights = 9.0 * rng.standard_normal((3, 4)), np.array(position_weights(3))
    rows, goal = rng.integers(0, 3, (500, 3)), rng.integers(0, 3, 500)
    got = seq.sgd(start, weights, rows, np.ones(rows.shape, bool), goal, 5.0, 0.05, 64)
    assert np.isfinite(got[0]).all() and np.abs(got[0]).max() <= 10
    assert got[1].min() >= 0.01 and got[1].max() <= 10


def model_rows(model):
    return {r.product_id: np.array(r.factor) for r in model.items.collect()}


def test_both_worker_forms_agree(spark):
    events = chain_events(spark, users=8, length=15)
    options = {"n_factors": 4, "k": 3, "epochs": 2, "workers": 3, "tie_cols": ("event_id",)}
    streamed = seq.train_sequence_model(events, **options)
    grouped = seq.train_sequence_model(events, broadcast_bytes=0, **options)
    a, b = model_rows(streamed), model_rows(grouped)
    assert set(a) == set(b) == {f"p{i}" for i in range(6)} | {PAD}
    assert all(np.allclose(a[i], b[i], atol=1e-12) for i in a)
    assert streamed.weights == pytest.approx(grouped.weights)
    assert streamed.metadata["history"] == pytest.approx(grouped.metadata["history"])


def test_only_mentioned_rows_are_shipped(spark, monkeypatch):
    """New events that mention few items ship few rows, however many the model has."""
    events, _ = random_events(spark, count=120)
    model = seq.train_sequence_model(events, epochs=1, tie_cols=("event_id",))
    shipped, real = [], seq.broadcast_items
    monkeypatch.setattr(seq, "broadcast_items", lambda *a: shipped.append(a[1].rows) or real(*a))
    few = events.where("product_id IN ('p0', 'p1')")
    seq.update_sequence_model(model, few, epochs=1, tie_cols=("event_id",))
    assert model.items.count() > 5 and shipped[0] <= 3


def test_average_divides_by_all_workers(spark):
    """One worker's change counts 1/W, as if idle workers returned the old model."""
    events = chain_events(spark, users=1, length=2)
    one = seq.train_sequence_model(events, epochs=1, workers=1, n_factors=4, k=2)
    four = seq.train_sequence_model(
        events, epochs=1, workers=4, n_factors=4, k=2, average="workers"
    )
    ids = spark.createDataFrame([(PAD,), ("p0",), ("p1",)], "product_id string")
    start = {r.product_id: np.array(r.factor) for r in seq.start_rows(ids, 4, 42).collect()}
    a, b = model_rows(one), model_rows(four)
    for item in start:
        assert np.allclose((a[item] - start[item]) / 4, b[item] - start[item])
    kept = seq.train_sequence_model(events, epochs=1, workers=4, n_factors=4, k=2)
    assert all(np.allclose(model_rows(kept)[i], a[i]) for i in a)


def test_training_learns_and_is_repeatable(spark):
    events = chain_events(spark)
    options = {
        "n_factors": 8, "k": 3, "epochs": 6, "lr": 0.3, "reg": 0.0001, "workers": 2,
        "tie_cols": ("event_id",),
    }
    model = seq.train_sequence_model(events, **options)
    history = model.metadata["history"]
    assert len(history) == 6 and history[-1] < 0.9 * history[0]
    assert seq.train_sequence_model(events.repartition(5), **options).metadata[
        "history"
    ] == pytest.approx(history)
    assert [r.epoch for r in seq.training_history(model).orderBy("epoch").collect()] == list(
        range(1, 7)
    )
    assert model.metadata["n_items"] == 7 and model.metadata["n_users"] == 30


def test_full_run_stops_early(spark):
    model = seq.train_sequence_model(
        chain_events(spark, 4, 6), n_factors=4, epochs=9, patience=2, min_delta=1.0, k=2
    )
    assert model.metadata["epochs_completed"] == 3


def test_top_n_never_offers_padding(spark):
    model = seq.train_sequence_model(chain_events(spark, 6, 12), n_factors=4, epochs=1, k=3)
    requests = spark.createDataFrame(
        [(1, ["p1"]), (2, ["x", "y", "z"]), (3, ["p1", "p2", "p3", "p4"])],
        "request_id long, click_sequence array<string>",
    )
    rows = seq.recommend_from_sequence(model, requests, n=50).collect()
    assert len(rows) == 18 and PAD not in {r.product_id for r in rows}
    unknown = sorted((r["rank"], r.product_id, r.score) for r in rows if r.request_id == 2)
    assert [u[1] for u in unknown] == [f"p{i}" for i in range(6)]
    assert {u[2] for u in unknown} == {0.0}


def test_serve_sequence_edges(spark):
    model = seq.train_sequence_model(chain_events(spark, 6, 12), n_factors=4, epochs=1, k=3)
    requests = spark.createDataFrame(
        [
            (1, None, 5, None, ["p1"]), (2, "u", 5, None, None), (3, "u", 5, None, []),
            (4, "u", 2, ["p0"], ["p1", "p2"]),
        ],
        schemas.REQUESTS,
    )
    rows = {r.request_id: r for r in recommend.serve_sequence_batch(requests, model).collect()}
    assert rows[1].error == "user_id is required"
    assert rows[2].error == rows[3].error == "click_sequence is required"
    assert len(rows[4].recommendations) == 2 and rows[4].click_sequence == ["p1", "p2"]
    assert "p0" not in {x.product_id for x in rows[4].recommendations}
    assert rows[4].metadata.sequence_length == 3


def write_clicks(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for user, item, when in rows:
            f.write(json.dumps({"user_id": user, "product_id": item, "timestamp": when}) + "\n")


def test_retraining_lifecycle(spark, folder):
    main, new = f"{folder}/clickstream.json", f"{folder}/clickstream_new.json"
    model, archive = f"{folder}/model", f"{folder}/archive"
    rows = [(f"u{i % 5}", f"p{i % 7}", at(i).isoformat()) for i in range(60)]
    write_clicks(main, rows)
    options = {"workers": 2, "epochs": 2}

    def run(**more):
        return retraining.run_training(spark, main, model, True, new, archive, **options, **more)

    first = run()
    assert first["mode"] == "full" and first["n_items"] == 8 and first["epochs_completed"] == 2
    assert run()["mode"] == "noop"
    versions = model_versions(spark, model, schemas.SEQUENCE_MODEL_METADATA)
    assert versions.count() == 1

    old = model_rows(seq.load_model(spark, model))
    fresh = [(f"n{i % 2}", f"q{i % 3}", 1_700_000_000.5 + i) for i in range(20)]
    write_clicks(new, fresh)
    second = run()
    assert second["mode"] == "incremental"
    assert (second["n_users"], second["n_items"]) == (7, 11)
    assert second["epochs_completed"] == 4 and second["total_training_samples"] == 80
    assert not os.path.exists(new) and os.path.exists(second["archived"].removeprefix("file:"))
    updated = model_rows(seq.load_model(spark, model))
    assert set(updated) - set(old) == {"q0", "q1", "q2"} and set(old) <= set(updated)
    info = model_info(spark, model, schemas.SEQUENCE_MODEL_METADATA).first()
    assert info.training_mode == "incremental" and len(info.history) == 4
    assert model_versions(spark, model, schemas.SEQUENCE_MODEL_METADATA).count() == 2


def test_samples_stay_in_their_buckets(spark):
    """After the first deal no epoch moves a sample; every worker has a bucket of its own."""
    from helpers import plan_of

    from clickloom.session import scratch_path

    samples = spark.range(500).selectExpr(
        "id AS sample", "xxhash64(id) AS draw", "array(id, id + 1) AS sequence", "id AS target"
    )
    name = seq._deal(samples, 6, scratch_path(spark, "buckets"))
    try:
        dealt = spark.table(name)
        assert dealt.select("worker").distinct().count() == 6 and dealt.count() == 500
        placed = dealt.sortWithinPartitions("worker").groupBy("worker").applyInArrow(
            lambda t: t.select(["sample"]), "sample long"
        )
        assert "Exchange" not in plan_of(placed)
        places = dealt.select("worker", F.input_file_name().alias("file")).distinct().collect()
        assert len(places) == len({p.file for p in places}) == len({p.worker for p in places}) == 6
    finally:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_workers_may_be_picked_by_a_column(spark, options):
    """Both ways to ship items agree, and so do two runs."""
    events = chain_events(spark, 9, 12)
    runs = [
        seq.train_sequence_model(
            events, n_factors=4, epochs=2, k=3, tie_cols=("event_id",), workers=3,
            deal_by="event_id", **more,
        )
        for more in (options, {})
    ]
    assert runs[0].metadata["history"] == pytest.approx(runs[1].metadata["history"])
    assert not any(t.name.startswith("clickloom_seq") for t in spark.catalog.listTables())


def test_solver_blocks_bound_what_is_sent(spark, monkeypatch):
    """Users x item blocks and items x user blocks grow with the ratings, not with their square."""
    per_user = 39
    for users in (15_000, 90_000, 540_000):
        n = users * per_user
        item_blocks = factor_model.solver_blocks(n, users)
        fewest = -(-n // factor_model.MOST_PER_BLOCK)
        assert item_blocks >= fewest
        assert item_blocks <= max(fewest, factor_model.MIN_BLOCKS)
        assert factor_model.solver_blocks(n, 100) == -(-n // factor_model.RATINGS_PER_BLOCK)
    monkeypatch.setattr(factor_model, "RATINGS_PER_BLOCK", 10)
    rated = spark.range(2000).selectExpr(
        "cast(id % 400 AS string) AS user_id", "cast(id DIV 400 AS string) AS product_id",
        "cast(id % 7 AS double) AS rating",
    )
    data = factor_model.index_ratings(rated)
    assert (data.user_blocks, data.item_blocks) == (40, 4)
    model = factor_model.train_factors(data, rank=2, epochs=1)
    assert (model.users.count(), model.items.count()) == (400, 5)


def test_solver_sends_grow_no_faster_than_ratings():
    """Events 6, 60 and 360 times sf0.1: as many vectors sent per rating at each size."""
    for users in (9_000, 90_000, 540_000):
        assert factor_model.solver_blocks(users * 39, users) == factor_model.MIN_BLOCKS
