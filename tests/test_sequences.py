import pytest
from helpers import events_of, plan_of, random_events

from clickloom.operators.sequences import click_sequences, recent_clicks

PAD = "<PAD>"


def history(rows):
    """Items per user in time order, missing times last, ties by event id."""
    users = {}
    for event, user, item, _, second in rows:
        if user is not None and item is not None:
            users.setdefault(user, []).append((second is None, second or 0, event, item))
    return {u: sorted(v) for u, v in users.items()}


def expected(rows, k):
    want = {}
    for clicks in history(rows).values():
        items = [c[3] for c in clicks]
        for i in range(len(items) - 1):
            seq = items[max(0, i - k + 1) : i + 1]
            want[clicks[i][2]] = ([PAD] * (k - len(seq)) + seq, items[i + 1])
    return want


def found(df):
    rows = df.collect()
    got = {r.event_id: (r.sequence, r.target) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("k", [1, 2, 10])
@pytest.mark.parametrize("hot_rows", [1_000_000, 60, 12, 3])
def test_against_brute_force(spark, k, hot_rows):
    events, rows = random_events(spark)
    got = click_sequences(events, k, tie_cols=("event_id",), hot_rows=hot_rows)
    assert found(got) == expected(rows, k)


def test_a_low_bound_does_not_ask_for_ever_more_slices(spark, monkeypatch):
    """What the driver samples and keeps per slice must not grow with the rows."""
    from clickloom.operators import sequences

    seen, real = [], sequences._slice_hot_users

    def watched(*args):
        cut = real(*args)
        seen.append(cut.where("_hot").select("_slice").distinct().count())
        return cut

    monkeypatch.setattr(sequences, "_slice_hot_users", watched)
    monkeypatch.setattr(sequences, "MAX_SLICES", 6, raising=False)
    events, rows = random_events(spark)
    got = click_sequences(events, 3, tie_cols=("event_id",), hot_rows=3)
    assert found(got) == expected(rows, 3)
    assert 1 < seen[0] <= 6
    monkeypatch.undo()
    assert sequences._slice_count(36_000_000, 200) == sequences.MAX_SLICES
    assert sequences._slice_count(36_000_000, 1_000_000) == 72
    assert sequences._slice_count(10**9, 200) == 2_000  # a slice stays what a task handles


def test_hot_user_with_one_time(spark):
    rows = [(i, "u", f"p{i}", "view", 5) for i in range(30)]
    rows += [(30 + i, "u", f"q{i}", "view", None) for i in range(30)]
    got = click_sequences(
        events_of(spark, rows), 4, tie_cols=("event_id",), hot_rows=10
    )
    assert found(got) == expected(rows, 4)


@pytest.mark.parametrize("clicks, count", [(1, 0), (2, 1), (10, 9), (11, 10), (12, 11)])
def test_counts(spark, clicks, count):
    rows = [(i, "u", f"p{i}", "view", i) for i in range(clicks)]
    got = found(click_sequences(events_of(spark, rows), tie_cols=("event_id",)))
    assert got == expected(rows, 10) and len(got) == count


def test_missing_keys_are_left_out(spark):
    rows = [
        (1, "u", "a", "view", 1), (2, "u", None, "view", 2),
        (3, "u", "b", "view", 3), (4, None, "c", "view", 4),
    ]
    got = found(click_sequences(events_of(spark, rows), 2, tie_cols=("event_id",)))
    assert got == {1: ([PAD, "a"], "b")}


def test_recent_clicks(spark):
    events, rows = random_events(spark)
    want = {u: [c[3] for c in v][-4:] for u, v in history(rows).items()}
    recent = recent_clicks(events, 4, tie_cols=("event_id",))
    assert {r.user_id: r.click_sequence for r in recent.collect()} == want
    plan = plan_of(recent)
    assert "row_number(), 4, Partial" in plan


def test_slices_of_a_burst_are_even(spark):
    """One user with one instant for most clicks: slices follow rows and not time."""
    from clickloom.operators.sequences import _slice_hot_users
    from clickloom.operators.skew import hot_keys

    rows = [(i, "u", f"p{i}", "view", 5 if i % 50 else i) for i in range(20_000)]
    events = events_of(spark, rows)
    hot = hot_keys(events, "user_id", min_rows=2_000)
    cut = _slice_hot_users(events, hot, "user_id", "event_time", ("event_id",), 2_000)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * 2_000


def test_clicks_alike_in_every_column_are_split(spark):
    """A bot's identical rows: slices stay even, sequences as if they were one history."""
    from pyspark.sql import functions as F

    from clickloom.operators import sequences

    count, hot_rows = 6000, 1000
    bot = spark.range(count).select(
        F.lit("bot").alias("user_id"), F.lit("p").alias("product_id"),
        F.lit("2024-01-01").cast("timestamp").alias("event_time"),
    )
    hot = spark.createDataFrame([("bot", count)], "user_id string, hot_rows long")
    sliced = sequences._slice_hot_users(bot, hot, "user_id", "event_time", (), hot_rows)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    target = hot_rows / sequences.SLICES_PER_TASK
    assert sum(sizes) == count and max(sizes) <= 2 * target
    found = click_sequences(bot, 4, hot_rows=hot_rows)
    lengths = found.groupBy(F.size(F.filter("sequence", lambda x: x != "<PAD>")).alias("n")).count()
    assert {r.n: r["count"] for r in lengths.collect()} == {1: 1, 2: 1, 3: 1, 4: count - 4}
