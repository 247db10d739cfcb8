"""Several sinks from one read: restarts, late rows, published lists."""

import os

import pytest
from helpers import at
from pyspark.sql import functions as F

from clickloom.streaming import fanout

LISTS = "user_id string, recs array<struct<product_id:string,score:double>>"
EVENTS = "event_id long, user_id string, product_id string, event_time timestamp"


def lists_of(spark, *items):
    recs = [(item, float(-n)) for n, item in enumerate(items)]
    return spark.createDataFrame([(u, recs) for u in "abz"], LISTS)


def add(spark, folder, rows, first=0):
    data = [(first + n, u, "p", None if s is None else at(s)) for n, (u, s) in enumerate(rows)]
    spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def start(spark, folder, recs, out="out", **options):
    events = spark.readStream.schema(EVENTS).parquet(f"{folder}/in")
    query = fanout.start_fan_out(
        events, recs, f"{folder}/{out}", f"{folder}/{out}-checkpoint", drain=True,
        keep=("event_id",), **options,
    )
    query.awaitTermination()
    return query


def rows_of(spark, folder, sink, *columns, out="out"):
    return sorted(
        (tuple(r) for r in fanout.read_sink(spark, f"{folder}/{out}", sink).select(*columns).collect()),
        key=str,
    )


ALERT = ("user_id", "window_start", "event_count", "batch")
BATCHES = [
    [("a", s) for s in range(4)] + [("b", 3)],
    [("a", s) for s in range(4, 8)] + [("z", 27), (None, 22), ("b", None)],
    [("a", 9), ("b", 25), ("z", 28)] + [("z", 40)],
    [("z", 100)],
]


def test_windows_grow_over_batches_and_late_rows_go_aside(spark, folder):
    for number, rows in enumerate(BATCHES):
        add(spark, folder, rows, 100 * number)
        start(spark, folder, lists_of(spark, "x", "p", "y"), threshold=3, n=1)
    # The third batch is measured against 27 s minus the delay: its row at 9 s is late.
    assert rows_of(spark, folder, fanout.LATE, "event_id", "batch") == [(200, 2)]
    assert rows_of(spark, folder, fanout.ALERTS, *ALERT) == [("a", at(0), 8, 1)]
    noted = fanout.progress(spark, f"{folder}/out").orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_rows, r.n_late) for r in noted] == [(0, 5, 0), (1, 7, 0), (2, 4, 1), (3, 1, 0)]
    assert [r.watermark for r in noted] == [at(-2), at(22), at(35), at(95)]
    # Late rows and those without time get their recommendations; unknown users none.
    found = rows_of(spark, folder, fanout.RECOMMENDATIONS, "event_id", "recommended_product_id")
    assert len(found) == sum(map(len, BATCHES)) - 1 and {r[1] for r in found} == {"x"}


def test_each_batch_is_read_once(spark, folder):
    add(spark, folder, BATCHES[0])
    query = start(spark, folder, lists_of(spark, "x"), more={"raw": lambda batch: batch})
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(BATCHES[0])
    assert len(rows_of(spark, folder, "raw", "event_id")) == len(BATCHES[0])


@pytest.mark.parametrize("sink", [fanout.RECOMMENDATIONS, "_windows", fanout.ALERTS, "_progress"])
def test_a_killed_run_ends_with_the_same_rows(spark, folder, monkeypatch, sink):
    lists, options = lists_of(spark, "x", "p"), {"threshold": 3}
    for number, rows in enumerate(BATCHES):
        add(spark, folder, rows, 100 * number)
        start(spark, folder, lists, **options)
        write, failed = fanout.FanOut._write, []

        def broken(self, rows, name, batch_id, write=write, failed=failed):
            write(self, rows, name, batch_id)
            if name == sink and not failed:
                failed.append(batch_id)
                raise OSError("killed")

        monkeypatch.setattr(fanout.FanOut, "_write", broken)
        with pytest.raises(Exception, match="killed"):
            start(spark, folder, lists, out="again", **options)
        start(spark, folder, lists, out="again", **options)
        monkeypatch.setattr(fanout.FanOut, "_write", write)
        assert failed == [number]
    for name, columns in (
        (fanout.ALERTS, ALERT), (fanout.LATE, ("event_id", "batch")),
        (fanout.RECOMMENDATIONS, ("event_id", "recommended_product_id", "batch")),
    ):
        assert rows_of(spark, folder, name, *columns) == rows_of(
            spark, folder, name, *columns, out="again"
        )


def test_a_replayed_batch_keeps_its_lists(spark, folder, monkeypatch):
    published = f"{folder}/lists"
    with pytest.raises(Exception, match="no lists are published|does not exist|PATH_NOT_FOUND"):
        add(spark, folder, [("a", 1)])
        start(spark, folder, published)
    fanout.publish_lists(lists_of(spark, "old"), published)
    write = fanout.FanOut._write

    def broken(self, rows, name, batch_id):
        if name == fanout.ALERTS:
            raise OSError("killed")
        write(self, rows, name, batch_id)

    monkeypatch.setattr(fanout.FanOut, "_write", broken)
    with pytest.raises(Exception, match="killed"):
        start(spark, folder, published)
    monkeypatch.setattr(fanout.FanOut, "_write", write)
    fanout.publish_lists(lists_of(spark, "new"), published)
    start(spark, folder, published)
    add(spark, folder, [("b", 2)], 100)
    start(spark, folder, published)
    found = rows_of(spark, folder, fanout.RECOMMENDATIONS, "event_id", "recommended_product_id")
    assert found == [(0, "old"), (100, "new")]
    versions = [r.version for r in fanout.progress(spark, f"{folder}/out").orderBy("batch_id").collect()]
    assert len(set(versions)) == 2


def test_old_windows_are_removed(spark, folder):
    for number, rows in enumerate(BATCHES):
        add(spark, folder, rows, 100 * number)
        start(spark, folder, lists_of(spark, "x"))
    assert sorted(f for f in os.listdir(f"{folder}/out/_windows")) == ["batch=2", "batch=3"]


def test_hot_users_are_salted(spark, folder):
    add(spark, folder, [("a", s) for s in range(50)])
    hot = spark.createDataFrame([("a", 50)], "user_id string, hot_rows long")
    start(spark, folder, lists_of(spark, "x"), hot_users=hot.where(F.lit(True)))
    assert len(rows_of(spark, folder, fanout.RECOMMENDATIONS, "event_id")) == 50
