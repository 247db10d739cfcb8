import numpy as np
import pytest
from helpers import events_of, plan_of, random_events
from pyspark.sql import functions as F

from clickloom.functions.clicks import EVENT_WEIGHTS
from clickloom.operators import keys, metrics, ratings
from clickloom.operators.indexing import dense_index
from clickloom.operators.skew import hot_keys, skew_join


def test_ratings_against_brute_force(spark):
    events, rows = random_events(spark)
    want = {}
    for _, user, item, kind, _ in rows:
        want[(user, item)] = want.get((user, item), 0.0) + EVENT_WEIGHTS.get(kind, 0.0)
    got = {(r.user_id, r.product_id): r.rating for r in ratings.build_ratings(events).collect()}
    assert got == want


def test_rating_edges(spark):
    events = events_of(
        spark,
        [(1, "u", "p", "?", 1), (2, None, "p", "view", 1), (3, "u", None, "view", 1)],
    )
    assert [tuple(r) for r in ratings.build_ratings(events).collect()] == [("u", "p", 0.0)]
    flat = spark.createDataFrame([("a", "x", 7.0), ("b", "x", 7.0)], "u string, p string, rating double")
    assert {r.rating for r in ratings.normalize_ratings(flat).collect()} == {3.0}


def test_normalize_bounds_and_plan(spark):
    events, _ = random_events(spark)
    scaled = ratings.normalize_ratings(ratings.build_ratings(events))
    low, high = scaled.agg(F.min("rating"), F.max("rating")).first()
    assert (low, high) == (1.0, 5.0)
    plan = plan_of(scaled)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_split_is_stable_and_complete(spark):
    events, _ = random_events(spark, 3000, 60, 60, hot_share=0.0)
    rated = ratings.build_ratings(events)
    train, test = ratings.split(rated)
    again, _ = ratings.split(rated.repartition(7))
    assert sorted(train.collect()) == sorted(again.collect())
    total = rated.count()
    assert train.count() + test.count() == total
    assert abs(train.count() / total - 0.8) < 0.04
    assert train.join(test, ["user_id", "product_id"]).count() == 0


@pytest.mark.parametrize("count", [1, 2, 501, 1000])
@pytest.mark.parametrize("distinct", [3, 10_000])
def test_exact_median(spark, count, distinct):
    rng = np.random.default_rng(count)
    values = rng.integers(0, distinct, count).astype(float)
    df = spark.createDataFrame([(v,) for v in values.tolist()], "rating double")
    assert ratings.exact_median(df, "rating", values_per_part=20) == np.median(values)


def test_rating_stats_empty(spark):
    row = ratings.rating_stats(spark.createDataFrame([], "rating double")).first()
    assert row.n_ratings == 0 and row.rating_median is None


def test_error_metrics(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0)], "rating double, prediction double")
    row = metrics.error_metrics(df).first()
    assert (row.rmse, row.mae, row.n) == (pytest.approx(2.5**0.5), 1.5, 2)
    empty = metrics.error_metrics(df.limit(0)).first()
    assert (empty.rmse, empty.mae, empty.n) == (None, None, 0)


def test_hot_keys_are_bounded(spark):
    events, rows = random_events(spark)
    counts = {}
    for r in rows:
        counts[r[1]] = counts.get(r[1], 0) + 1
    hot = hot_keys(events, "user_id", min_rows=100)
    assert {r.user_id: r.hot_rows for r in hot.collect()} == {
        u: n for u, n in counts.items() if n > 100
    }
    assert hot_keys(events, "user_id", min_rows=10, max_keys=2).count() == 2
    assert hot_keys(events, "user_id", min_rows=10_000) is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, how):
    events, _ = random_events(spark)
    small = spark.createDataFrame(
        [("u0", 1), ("u0", 2), ("u1", 3), ("u9", 4)], "user_id string, x int"
    )
    columns = [*events.columns, "x"]
    plain = sorted(map(str, events.join(small, "user_id", how).select(columns).collect()))
    hot = hot_keys(events, "user_id", min_rows=20)
    salted = skew_join(events, small, "user_id", how, hot, rows_per_task=20)
    assert sorted(map(str, salted.select(columns).collect())) == plain


def test_dense_index(spark):
    df = spark.createDataFrame([(f"k{i % 300}",) for i in range(900)] + [(None,)], "k string")
    rows = dense_index(df, "k").collect()
    assert sorted(r["index"] for r in rows) == list(range(300))
    again = {r.k: r["index"] for r in dense_index(df.repartition(5), "k", 1024).collect()}
    assert again == {r.k: r["index"] for r in rows}


def test_exclude_fraud_keeps_users_without_id(spark):
    users = spark.createDataFrame([("a",), ("b",), (None,)], "user_id string")
    fraud = spark.createDataFrame([("b",), ("b",)], "user_id string")
    left = {r.user_id for r in keys.exclude_fraud(users, fraud).collect()}
    assert left == {"a", None}
    with_null = fraud.unionByName(spark.createDataFrame([(None,)], "user_id string"))
    assert {r.user_id for r in keys.exclude_fraud(users, with_null).collect()} == {"a"}


def test_new_keys_and_append(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    new = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "k string")
    assert [r.k for r in keys.new_keys(new, old, "k").collect()] == ["c"]
    both = keys.append(old, new)
    assert both.count() == 6 and both.filter("x is null").count() == 4
    row = keys.count_distinct(both, "k").first()
    assert (row.n_rows, row.n_k) == (6, 3)
    assert keys.count_distinct(both, "k", approximate=True).first().n_k == 3


def test_many_hot_keys_stay_a_table(spark, monkeypatch):
    """Beyond the bound the list is neither collected nor broadcast, and splits the same rows."""
    from helpers import plan_of

    from clickloom.operators import skew

    events, rows = random_events(spark, 500)
    users = events.select("user_id").distinct().withColumn("x", F.length("user_id"))
    want = sorted(events.join(users, "user_id").select("event_id", "x").collect())
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 2)
    hot = skew.hot_keys(events, "user_id", min_rows=5)
    assert hot.count() > 2
    found = skew.skew_join(events, users, "user_id", "inner", hot, rows_per_task=20)
    assert sorted(found.select("event_id", "x").collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = skew.skew_join(events, users, "user_id", "inner", hot, rows_per_task=20)
        assert "Broadcast" not in plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
