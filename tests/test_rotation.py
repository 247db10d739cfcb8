"""Factor training in epochs: against plain arithmetic, resumed, stopped, co-partitioned."""

import numpy as np
import pytest
from helpers import plan_of, random_events

from clickloom.plans import factor_model, rotation
from clickloom.plans.factor_model import FactorModel
from clickloom.plans.stopping import Patience

RNG = np.random.default_rng(4)
PAIRS = {(int(RNG.integers(30)), int(RNG.integers(20))) for _ in range(250)}
RATED = [(f"u{u}", f"p{i}", float(RNG.integers(1, 6))) for u, i in sorted(PAIRS)]
START = {
    "user_id": {f"u{u}": RNG.standard_normal(5) for u in range(32)},
    "product_id": {f"p{i}": RNG.standard_normal(5) for i in range(21)},
}


def ratings_of(spark, rows=RATED):
    return spark.createDataFrame(rows, "user_id string, product_id string, rating double")


def given(spark):
    frames = [
        spark.createDataFrame(
            [(k, v.tolist()) for k, v in START[key].items()], f"{key} string, factor array<double>"
        )
        for key in ("user_id", "product_id")
    ]
    return FactorModel(*frames, {"n_factors": 5})


def vectors_of(df):
    return {row[0]: np.array(row[1]) for row in df.collect()}


def one_step(lr, reg):
    """All ratings at once: each row moves by its mean gradient, as often as it occurs."""
    grads, squares = {}, 0.0
    for u, i, r in RATED:
        p, q = START["user_id"][u], START["product_id"][i]
        err = np.clip(r - p @ q, -10, 10)
        squares += err**2
        grads.setdefault(u, []).append(err * q - reg * p)
        grads.setdefault(i, []).append(err * p - reg * q)
    old = START["user_id"] | START["product_id"]
    new = {
        k: np.clip(v + (1 - (1 - lr) ** len(grads[k])) * np.mean(grads[k], axis=0), -10, 10)
        if k in grads else v
        for k, v in old.items()
    }
    return new, np.sqrt(squares / len(RATED))


def test_one_step_from_given_vectors(spark):
    model = factor_model.train_by_rotation(
        ratings_of(spark), epochs=1, start=given(spark), blocks=1, batch=1 << 40, lr=0.1, reg=0.05
    )
    new, rmse = one_step(0.1, 0.05)
    got = vectors_of(model.users) | vectors_of(model.items)
    assert got.keys() == new.keys()
    assert all(np.allclose(got[k], new[k]) for k in new)
    assert model.metadata["history"] == [pytest.approx(rmse)]
    assert factor_model.training_history(model).collect()[0].rmse == pytest.approx(rmse)


def test_one_step_over_all_ratings_is_cut_into_parts(spark, monkeypatch):
    """No task holds more than about a part of the ratings, and the step stays the same."""
    largest = []
    deal = rotation.deal

    def watched(*args):
        plan = deal(*args)
        rows = plan.step(0).selectExpr("input_file_name() AS f").groupBy("f").count()
        largest.append(max(r["count"] for r in rows.collect()))
        return plan

    monkeypatch.setattr(rotation, "deal", watched)
    monkeypatch.setattr(rotation, "RATINGS_PER_PART", 25, raising=False)
    monkeypatch.setattr(rotation, "CHUNK", 7, raising=False)
    model = factor_model.train_by_rotation(
        ratings_of(spark), epochs=1, start=given(spark), blocks=1, batch=1 << 40, lr=0.1, reg=0.05
    )
    new, rmse = one_step(0.1, 0.05)
    got = vectors_of(model.users) | vectors_of(model.items)
    assert got.keys() == new.keys()
    assert all(np.allclose(got[k], new[k]) for k in new)
    assert model.metadata["history"] == [pytest.approx(rmse)]
    assert largest[0] < len(RATED) / 2


def test_parts_of_several_blocks_move_as_the_blocks_do(spark, monkeypatch):
    found = []
    for size in (1 << 40, 10):
        monkeypatch.setattr(rotation, "RATINGS_PER_PART", size, raising=False)
        model = factor_model.train_by_rotation(
            ratings_of(spark), epochs=2, start=given(spark), blocks=4, strata=2, batch=1 << 40,
            lr=0.1, reg=0.05,
        )
        found.append((vectors_of(model.users) | vectors_of(model.items), model.metadata["history"]))
    (whole, errors), (cut, more) = found
    assert whole.keys() == cut.keys() and all(np.allclose(whole[k], cut[k]) for k in whole)
    assert more == [pytest.approx(e) for e in errors]


def test_items_of_several_blocks_are_averaged(spark):
    """Six blocks work on two strata: with lr small enough steps add up, so the mean shows."""
    plan = rotation.deal(ratings_of(spark), blocks=6, strata=2)
    try:
        assert plan.strata == 2 and plan.n_ratings == len(RATED)
        steps = [plan.step(s).collect() for s in range(2)]
        assert sum(map(len, steps)) == len(RATED)
        start = given(spark)
        users, items, _ = rotation._run_step(
            plan, plan.step(0), start.users, start.items, rotation._kernel(0.0, 0.01, 0.0, 1 << 40, 1)
        )
        changes = {}
        for block in {r._block for r in steps[0]}:
            own = [r for r in steps[0] if r._block == block]
            for i in {r.product_id for r in own}:
                q = START["product_id"][i]
                errs = [
                    (r.rating - START["user_id"][r.user_id] @ q) * START["user_id"][r.user_id]
                    for r in own if r.product_id == i
                ]
                rate = 1 - 0.99 ** len(errs)
                changes.setdefault(i, []).append(rate * np.mean(errs, axis=0))
        got = vectors_of(items)
        for i, q in START["product_id"].items():
            assert np.allclose(got[i], q + np.mean(changes[i], axis=0) if i in changes else q)
        assert vectors_of(users).keys() == START["user_id"].keys()
    finally:
        plan.drop()


def test_no_two_blocks_of_a_step_share_a_stratum(spark):
    plan = rotation.deal(ratings_of(spark), blocks=4, strata=4)
    try:
        seen = []
        for step in range(4):
            rows = plan.step(step).collect()
            blocks = {}
            for r in rows:
                blocks.setdefault(r.product_id, set()).add(r._block)
            assert all(len(b) == 1 for b in blocks.values())
            seen += [(r.user_id, r.product_id) for r in rows]
        assert sorted(seen) == sorted((u, i) for u, i, _ in RATED)
    finally:
        plan.drop()


def test_ratings_do_not_move_after_they_are_dealt(spark):
    plan = rotation.deal(ratings_of(spark), blocks=8, strata=2)
    try:
        rated = plan.step(0)
        assert "Exchange" not in plan_of(rated.select("_block", "product_id").distinct())
        both = rated.groupBy("_block").cogroup(given(spark).users.selectExpr(
            "0 AS _block", "user_id").groupBy("_block"))
        joined = both.applyInArrow(lambda a, b: a.select(["user_id"]), "user_id string")
        assert plan_of(joined).count("Exchange") == 1  # the vectors'
    finally:
        plan.drop()


@pytest.mark.parametrize("blocks", [1, 4])
def test_a_resumed_run_equals_one_without_a_break(spark, folder, blocks):
    options = {"blocks": blocks, "strata": 2, "lr": 0.1, "patience": None, "rank": 4, "batch": 16}
    whole = factor_model.train_by_rotation(ratings_of(spark), epochs=3, **options)
    path = f"{folder}/model"
    factor_model.train_by_rotation(ratings_of(spark), epochs=1, path=path, **options)
    resumed = factor_model.train_by_rotation(ratings_of(spark), epochs=3, path=path, **options)
    assert resumed.metadata["history"] == pytest.approx(whole.metadata["history"])
    assert len(resumed.metadata["history"]) == 3
    for a, b in ((whole.users, resumed.users), (whole.items, resumed.items)):
        a, b = vectors_of(a), vectors_of(b)
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_warm_start_keeps_known_vectors_and_adds_new_ids(spark):
    rows = [*RATED, ("new user", "p1", 3.0), ("u1", "new item", 4.0)]
    model = factor_model.train_by_rotation(
        ratings_of(spark, rows), epochs=1, start=given(spark), lr=0.0, blocks=2
    )
    users, items = vectors_of(model.users), vectors_of(model.items)
    assert users.keys() == START["user_id"].keys() | {"new user"}
    assert items.keys() == START["product_id"].keys() | {"new item"}
    assert all(np.allclose(users[k], v) for k, v in START["user_id"].items())


def test_the_error_falls_and_the_best_epoch_is_kept(spark):
    rng = np.random.default_rng(0)
    p, q = rng.standard_normal((40, 3)), rng.standard_normal((30, 3))
    rows = [
        (f"u{u}", f"p{i}", 3 + float(p[u] @ q[i])) for u in range(40) for i in range(30)
        if rng.random() < 0.6
    ]
    rated = ratings_of(spark, rows)
    train, held = rated.randomSplit([0.8, 0.2], 1)
    model = factor_model.train_by_rotation(
        train, rank=6, epochs=25, validation=held, lr=0.1, reg=0.02, batch=8, blocks=2, patience=3
    )
    history, checked = model.metadata["history"], model.metadata["validation_history"]
    assert len(history) == len(checked) and history[-1] < 0.7 * history[0]
    best = model.metadata["epochs_completed"]
    assert checked[best - 1] <= min(checked) + 1e-4
    assert factor_model.evaluate(model, held).first().rmse == pytest.approx(checked[best - 1])


def test_solvers_share_one_entry(spark, folder):
    events, _ = random_events(spark, 600, 12, 12)
    model, train = factor_model.train_factor_model(events, solver="rotation", epochs=2, rank=4)
    assert len(model.metadata["history"]) == 2 and model.metadata["training_samples"] == train.count()
    factor_model.save_model(model, f"{folder}/m")
    loaded = factor_model.load_model(spark, f"{folder}/m")
    assert list(loaded.metadata["history"]) == model.metadata["history"]
    with pytest.raises(ValueError, match="unknown solver"):
        factor_model.train_factor_model(events, solver="other")


def test_no_ratings(spark):
    model = factor_model.train_by_rotation(ratings_of(spark, []), epochs=2)
    assert model.users.count() == model.items.count() == 0


def test_patience():
    watch = Patience(2, 0.1)
    assert [watch.stops(v, e) for e, v in enumerate([1.0, 0.95, 0.8, 0.79, 0.78], 1)] == [
        False, False, False, False, True,
    ]
    assert watch.best_epoch == 3
    assert not any(Patience(None, 0.0).stops(1.0, e) for e in range(9))
