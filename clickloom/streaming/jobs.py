"""Continuous jobs: fraud alerts, event recommendations and request serving.

The transformations are the batch functions; this module adds the watermark,
the state store, the sink, the checkpoint and the trigger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.windows import DELAY, THRESHOLD, WINDOW, fraud_windows, with_delay
from clickloom.plans.recommend import EVENT_RECOMMENDATIONS, lateral_recommend
from clickloom.session import ROCKSDB_PROVIDER

CHECKPOINT_INTERVAL = "10 seconds"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep keyed state on local disk and not in the executor heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def start_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = CHECKPOINT_INTERVAL,
    drain: bool = False,
    table: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Exactly-once append to Parquet files, or to a catalog table.

    ``drain`` processes what is there, emits the windows the watermark closes
    and stops.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    if name:
        writer = writer.queryName(name)
    if table:
        return writer.format("parquet").option("path", path).toTable(table)
    return writer.format("parquet").start(path)


def fraud_alerts(
    events: DataFrame,
    window: str = WINDOW,
    threshold: int = THRESHOLD,
    delay: str = DELAY,
    **columns,
) -> DataFrame:
    """Alerts of a stream: a window is emitted once, when the watermark has passed its end.

    Rows later than the watermark are dropped; windows still open when the input
    ends are held back, while the batch function reports them.
    """
    time_col = columns.get("time_col", "event_time")
    delayed = with_delay(events, time_col, delay)
    return fraud_windows(delayed, window, threshold, **columns)


def start_fraud_stream(
    events: DataFrame, path: str, checkpoint: str, drain: bool = False, **options
) -> StreamingQuery:
    use_rocksdb(events.sparkSession)
    return start_stream(fraud_alerts(events, **options), path, checkpoint, drain=drain)


def start_recommendation_stream(
    events: DataFrame,
    recs: DataFrame,
    path: str,
    checkpoint: str,
    n: int = EVENT_RECOMMENDATIONS,
    keep: tuple[str, ...] = (),
    hot_users: DataFrame | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Recommendations per event by a stream-static join with the table of user lists.

    ``hot_users`` comes from ``hot_keys`` over past events; their rows are salted.
    """
    found = lateral_recommend(events, recs, n, keep, hot_users)
    return start_stream(found, path, checkpoint, drain=drain)


def start_fraud_and_recommendations(
    events: DataFrame,
    recs: DataFrame,
    path: str,
    checkpoint: str,
    drain: bool = False,
    hot_users: DataFrame | None = None,
    **options,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two sinks from one source, each with its own checkpoint and pace."""
    alerts = start_fraud_stream(
        events, f"{path}/fraud_attempts", f"{checkpoint}/fraud_attempts", drain, **options
    )
    found = start_recommendation_stream(
        events,
        recs,
        f"{path}/user_recommendations",
        f"{checkpoint}/user_recommendations",
        hot_users=hot_users,
        drain=drain,
    )
    return alerts, found


def start_serving_stream(
    requests: DataFrame,
    respond: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    interval: str = CHECKPOINT_INTERVAL,
    drain: bool = False,
) -> StreamingQuery:
    """Answer a stream of requests with a batch scorer.

    Each micro-batch overwrites its own folder, so a replayed batch leaves no
    second answer. A scorer measures a batch before it answers, so the batch is
    read once and kept until it is answered. With a ``recommend.Scorer`` the model
    is measured and shipped once for the whole stream; close it when the query ends.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            respond(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(answer)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()
