"""Requests answered once per distinct asker, by a scorer that is prepared once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.clicks import PAD
from clickloom.plans import recommend
from clickloom.plans.factor_model import FactorModel
from clickloom.plans.sequence_model import SequenceModel
from clickloom.streaming import jobs

RNG = np.random.default_rng(8)
USERS = {f"u{i}": RNG.integers(-3, 4, 4).astype(float) for i in range(12)}
ITEMS = {f"p{i:02}": RNG.integers(-3, 4, 4).astype(float) for i in range(40)}


def frame(spark, rows, key):
    return spark.createDataFrame(
        [(k, v.tolist()) for k, v in rows.items()], f"{key} string, factor array<double>"
    )


@pytest.fixture(scope="module")
def model(spark):
    return FactorModel(frame(spark, USERS, "user_id"), frame(spark, ITEMS, "product_id"), {})


def requests_of(spark, count=300):
    rows = []
    for i in range(count):
        user = "u0" if i % 3 == 0 else f"u{RNG.integers(14)}"  # u12, u13 are unknown
        out = sorted({f"p{RNG.integers(45):02}" for _ in range(RNG.integers(0, 20))})
        n = [None, 0, 1, 7, 60][RNG.integers(5)]
        rows.append((i, user, n, None if i % 7 == 0 else out, None))
    return spark.createDataFrame(rows, schemas.REQUESTS), rows


def best(vector, n, out):
    scored = sorted((-float(vector @ v), p) for p, v in ITEMS.items() if p not in out)
    return [(p, -s) for s, p in scored[:n]]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "items_per_block": 11}])
def test_answers_equal_those_of_single_requests(spark, model, options):
    requests, rows = requests_of(spark)
    found = {r.request_id: r for r in recommend.serve_batch(requests, model, **options).collect()}
    assert len(found) == len(rows)
    for i, user, n, out, _ in rows:
        want = best(USERS[user], 5 if n is None else n, out or []) if user in USERS else []
        assert [tuple(x) for x in found[i].recommendations] == want
        assert found[i].error is None and found[i].user_id == user


def test_work_follows_distinct_users(spark, model):
    """Three hundred requests of one user score the catalogue once."""
    rows = [(i, "u1", 5, [f"p{i % 3:02}"], None) for i in range(300)]
    requests = spark.createDataFrame(rows, schemas.REQUESTS)
    scored = spark.sparkContext.accumulator(0)
    assert recommend.serve_batch(requests, model, scored=scored).count() == 300
    assert 0 < scored.value <= len(ITEMS)


def test_equal_click_sequences_are_scored_once(spark):
    items = frame(spark, {**ITEMS, PAD: np.zeros(4)}, "product_id")
    model = SequenceModel(items, None, [0.5, 0.3, 0.2], {"sequence_length": 3})
    rows = [(i, f"u{i}", 4, [f"p{i % 4:02}"], ["p01", "p02"]) for i in range(200)]
    requests = spark.createDataFrame(rows, schemas.REQUESTS)
    scored = spark.sparkContext.accumulator(0)
    found = recommend.serve_sequence_batch(requests, model, scored=scored).collect()
    encoded = (0.3 * ITEMS["p01"] + 0.2 * ITEMS["p02"]) / 3
    for r in found:
        want = best(encoded, 4, [f"p{r.request_id % 4:02}"])
        assert [x.product_id for x in r.recommendations] == [p for p, _ in want]
    assert 0 < scored.value <= len(ITEMS)


def test_hot_askers_are_salted(spark, model, monkeypatch):
    requests, rows = requests_of(spark, 120)
    plain = recommend.serve_batch(requests, model).collect()
    monkeypatch.setattr(
        recommend, "hot_keys",
        lambda df, key: df.groupBy(key).agg(F.lit(5_000_000).cast("long").alias("hot_rows")),
    )
    assert sorted(recommend.serve_batch(requests, model).collect()) == sorted(plain)


def test_a_scorer_serves_many_batches_of_a_stream(spark, model, folder, monkeypatch):
    """Twenty micro-batches: the items are measured and shipped once, and freed at the end."""
    from clickloom.operators import topn

    calls = []
    real = topn.measure
    monkeypatch.setattr(topn, "measure", lambda *a: calls.append(1) or real(*a))
    requests, rows = requests_of(spark, 60)
    requests.repartition(20).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1)
    with recommend.Scorer(model) as scorer:
        query = jobs.start_serving_stream(
            stream.parquet(f"{folder}/in"), scorer, f"{folder}/out", f"{folder}/ck", drain=True
        )
        query.awaitTermination()
        assert scorer.prepared._shipped is not None
    assert scorer.prepared._shipped is None and len(calls) == 1
    answers = {r.request_id: r for r in spark.read.parquet(f"{folder}/out").collect()}
    assert len(answers) == 60
    for i, user, n, out, _ in rows:
        want = best(USERS[user], 5 if n is None else n, out or []) if user in USERS else []
        assert [tuple(x) for x in answers[i].recommendations] == want


# --- the table function -----------------------------------------------------


def text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_table_function_unfolds_behind_the_join(spark, model):
    from helpers import plan_of

    lists = recommend.user_lists(model, n=5)
    rows = [(i, f"u{i % 14}", None if i % 9 == 0 else f"p{i % 45:02}") for i in range(200)]
    events = spark.createDataFrame(rows, "event_id long, user_id string, product_id string")
    events.createOrReplaceTempView("asked_events")
    recommend.register_table_function(lists, events.schema, "suggest")
    query = """
        SELECT * FROM suggest(TABLE(
          SELECT e.event_id, e.user_id, e.product_id, l.recs
          FROM asked_events e JOIN suggest_lists l USING (user_id)) {more}, {n})"""
    want = {
        n: text(recommend.lateral_recommend(events, lists, n, keep=("event_id",))) for n in (5, 2)
    }
    for n, rows in want.items():
        assert text(spark.sql(query.format(n=n, more=""))) == rows
    split = spark.sql(query.format(n=5, more="PARTITION BY (user_id, pmod(hash(event_id), 3))"))
    assert text(split) == want[5]
    assert spark.sql(query.format(n=0, more="")).count() == 0
    plan = plan_of(spark.sql(query.format(n=5, more="")))
    assert "UDTF" in plan and "Generate" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("shipped", [1 << 30, 100, 0])
def test_predictions_with_vectors_of_any_size(spark, model, monkeypatch, shipped):
    from clickloom.plans import factor_model

    monkeypatch.setattr(factor_model, "SHIPPED_BYTES", shipped)
    rows = [(f"u{i % 14}", f"p{i % 45:02}", float(i)) for i in range(300)]
    pairs = spark.createDataFrame(rows, "user_id string, product_id string, rating double")
    found = factor_model.predict(model, pairs)
    assert found.columns == ["user_id", "product_id", "rating", "prediction"]
    for r in found.collect():
        known = r.user_id in USERS and r.product_id in ITEMS
        want = float(USERS[r.user_id] @ ITEMS[r.product_id]) if known else 0.0
        assert r.prediction == pytest.approx(want)
