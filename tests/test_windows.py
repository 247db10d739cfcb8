import json

import pytest
from helpers import at, events_of, plan_of

from clickloom.operators.windows import fraud_windows
from clickloom.schemas import CLICKSTREAM
from clickloom.sources.readers import read_clickstream, read_clickstream_stream
from clickloom.streaming import jobs


def burst_events(spark, burst=True):
    """Two normal events per 10 s over 20 users, then three users with 17 events in 7 s."""
    rows = [(i, f"u{i % 20}", "p", "view", i * 5) for i in range(200)]
    begin = 200 * 5 + 60
    if burst:
        for user in ("u1", "u2", "u3"):
            rows += [(0, user, "p", "view", begin + i * 0.5) for i in range(15)]
            rows += [(0, user, "p", "payment_failed", begin + i * 0.6) for i in range(2)]
    return events_of(spark, [(n, *r[1:]) for n, r in enumerate(rows)])


def alerts(df):
    return sorted((r.user_id, r.window_start, r.window_end, r.event_count) for r in df.collect())


def test_burst_alerts_exactly_three_users(spark):
    found = alerts(fraud_windows(burst_events(spark)))
    assert {a[0] for a in found} == {"u1", "u2", "u3"}
    assert 3 <= len(found) <= 6
    assert all((a[2] - a[1]).total_seconds() == 10 for a in found)
    assert alerts(fraud_windows(burst_events(spark, burst=False))) == []


def test_threshold_is_strict_and_windows_half_open(spark):
    rows = [(i, "five", "p", "view", i) for i in range(5)]
    rows += [(i, "six", "p", "view", i) for i in range(6)]
    rows += [(i, "edge", "p", "view", 5 + i) for i in range(6)]  # 5..10: the last is outside
    rows += [(i, None, "p", "view", i) for i in range(6)]
    rows += [(9, "six", "p", "view", None)]
    events = events_of(spark, rows)
    found = alerts(fraud_windows(events.filter("user_id is not null")))
    assert found == [("six", at(0), at(10), 6)]
    with_null = fraud_windows(events).collect()
    assert {r.user_id for r in with_null} == {"six", None}
    counted = fraud_windows(events, count_col="user_id").collect()
    assert {r.user_id for r in counted} == {"six"}


def test_counts_are_partially_aggregated(spark):
    plan = plan_of(fraud_windows(burst_events(spark)))
    assert plan.count("HashAggregate") == 2 and "partial_count" in plan


def write_lines(path, rows):
    with open(path, "w") as f:
        for user, seconds in rows:
            f.write(
                json.dumps(
                    {
                        "timestamp": at(seconds).isoformat(),
                        "user_id": user,
                        "product_id": "p",
                        "event_type": "view",
                    }
                )
                + "\n"
            )


def run_stream(spark, folder, files, **options):
    import os

    os.makedirs(f"{folder}/in")
    for name, rows in files.items():
        write_lines(f"{folder}/in/{name}", rows)
        os.utime(f"{folder}/in/{name}", (1_700_000_000 + len(name) + sum(map(ord, name)),) * 2)
    events = read_clickstream_stream(spark, f"{folder}/in", max_files_per_trigger=1)
    query = jobs.start_fraud_stream(
        events, f"{folder}/out", f"{folder}/checkpoint", drain=True, **options
    )
    query.awaitTermination()
    return alerts(spark.read.parquet(f"{folder}/out"))


def test_stream_equals_batch_and_withholds_open_windows(spark, folder):
    rows = [("a", i) for i in range(8)] + [("b", 30 + i) for i in range(7)]
    found = run_stream(spark, folder, {"clickstream-1.json": rows})
    batch = alerts(fraud_windows(read_clickstream(spark, f"{folder}/in")))
    assert len(batch) == 2
    # The last window ends after the watermark (max time minus 5 s), so it stays open.
    assert found == [a for a in batch if a[2] <= at(36 - 5)]


def test_late_rows_are_dropped_after_the_watermark_moved(spark, folder):
    early = [("a", i) for i in range(6)]
    files = {
        "clickstream-1.json": [("z", 100)],
        "clickstream-2.json": [("z", 101)],
        "clickstream-3.json": early,
        "clickstream-4.json": [("z", 300)],
    }
    assert run_stream(spark, folder, files) == []


def test_stream_rerun_adds_nothing(spark, folder):
    rows = [("a", i) for i in range(8)] + [("z", 60)]
    first = run_stream(spark, folder, {"clickstream-1.json": rows})
    events = read_clickstream_stream(spark, f"{folder}/in")
    again = jobs.start_fraud_stream(
        events, f"{folder}/out", f"{folder}/checkpoint", drain=True
    )
    again.awaitTermination()
    assert alerts(spark.read.parquet(f"{folder}/out")) == first == [("a", at(0), at(10), 8)]


def test_two_sinks_and_table_sink(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    write_lines(f"{folder}/in/clickstream-1.json", [("a", i) for i in range(8)] + [("z", 60)])
    recs = spark.createDataFrame(
        [("a", [("q", 2.0), ("p", 1.0), ("r", 0.5)])],
        "user_id string, recs array<struct<product_id:string,score:double>>",
    )
    both = jobs.start_fraud_and_recommendations(
        read_clickstream_stream(spark, f"{folder}/in"),
        recs,
        f"{folder}/out",
        f"{folder}/checkpoint",
        drain=True,
    )
    for query in both:
        query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out/fraud_attempts").count() == 1
    found = spark.read.parquet(f"{folder}/out/user_recommendations")
    assert found.count() == 16
    assert {r.recommended_product_id for r in found.collect()} == {"q", "r"}


def test_table_sink(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    write_lines(f"{folder}/in/clickstream-1.json", [("a", i) for i in range(8)] + [("z", 60)])
    events = read_clickstream_stream(spark, f"{folder}/in")
    name = "clickloom_stream_alerts"
    query = jobs.start_stream(
        jobs.fraud_alerts(events), f"{folder}/out", f"{folder}/ck", drain=True, table=name
    )
    query.awaitTermination()
    assert alerts(spark.table(name)) == [("a", at(0), at(10), 8)]
    spark.sql(f"DROP TABLE {name}")


def test_serving_stream_answers_once_per_batch(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    write_lines(f"{folder}/in/clickstream-1.json", [("a", 1), ("b", 2)])
    requests = spark.readStream.schema(CLICKSTREAM).json(f"{folder}/in")
    query = jobs.start_serving_stream(
        requests, lambda df: df.select("user_id"), f"{folder}/out", f"{folder}/ck", drain=True
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").select("user_id").collect()
    assert sorted(r.user_id for r in rows) == ["a", "b"]


@pytest.mark.parametrize("mode, count", [("lenient", 2), ("strict", 1)])
def test_time_mode_of_reader(spark, folder, mode, count):
    write_lines(f"{folder}/clickstream-1.json", [("a", 1), ("b", 2.000001)])
    df = read_clickstream(spark, folder, mode=mode)
    assert df.filter("event_time is not null").count() == count
