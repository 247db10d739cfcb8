"""Several sinks from one read of a stream, late rows among them.

Every micro-batch is read once and kept until all sinks have their share. A sink has
a folder per batch, which a replay of the batch overwrites, and the counts of windows
still open are a table per batch, made from the one before; so a job that is killed
anywhere and started again ends with the same rows.

A batch is measured against the watermark of the batches before it: rows of windows
that it closed are late; they go to a sink of their own and are counted. Windows that
the new watermark has passed are reported.

Recommendations come from a frame, or from lists that are published as versions. A
batch notes the version it starts with, so a replay uses the same lists while the
next batch takes the latest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schemas
from clickloom.operators.windows import DELAY, THRESHOLD, WINDOW
from clickloom.plans.recommend import EVENT_RECOMMENDATIONS, lateral_recommend
from clickloom.sources.files import exists, remove_path
from clickloom.sources.models import load_version, model_info, save_version

ALERTS, RECOMMENDATIONS, LATE = "fraud_attempts", "user_recommendations", "late_events"
INTERVAL = "10 seconds"
# A finished batch: its watermark (microseconds while in use), rows, late rows, lists.
NOTED = "batch_id long, watermark long, n_rows long, n_late long, version string"
PROGRESS = NOTED.replace("watermark long", "watermark timestamp")


def publish_lists(lists: DataFrame, path: str) -> str:
    """Store user lists as a new version, which running streams take up with their next batch."""
    meta = {"n_users": lists.count()}
    return save_version(lists.sparkSession, path, {"lists": lists}, meta, schemas.LISTS_METADATA)


class FanOut:
    """Deals one micro-batch out to its sinks below ``path``."""

    def __init__(
        self,
        path: str,
        recs: DataFrame | str,
        window: str = WINDOW,
        threshold: int = THRESHOLD,
        delay: str = DELAY,
        n: int = EVENT_RECOMMENDATIONS,
        keep: tuple[str, ...] = (),
        hot_users: DataFrame | None = None,
        time_col: str = "event_time",
        more: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    ):
        self.path, self.recs, self.hot_users = path, recs, hot_users
        self.window, self.threshold, self.delay = window, threshold, delay
        self.n, self.keep, self.time_col, self.more = n, keep, time_col, more or {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            before = self.before(spark, batch_id)
            lists, version = self._lists(spark, batch_id)
            found = lateral_recommend(batch, lists, self.n, self.keep, self.hot_users)
            self._write(found, RECOMMENDATIONS, batch_id)
            for sink, transform in self.more.items():
                self._write(transform(batch), sink, batch_id)
            rows = batch.withColumn("_window", F.window(self.time_col, self.window))
            late = F.lit(False)
            if before and before["watermark"] is not None:
                late = F.col("_window.end") <= F.timestamp_micros(F.lit(before["watermark"]))
            passed = F.max(self.time_col) - F.expr(f"INTERVAL {self.delay}")
            n_rows, newest = batch.agg(F.count(F.lit(1)), F.unix_micros(passed)).first()
            n_late = rows.where(late).count()
            self._write(rows.where(late).drop("_window"), LATE, batch_id)
            marks = [m for m in (before and before["watermark"], newest) if m is not None]
            watermark = max(marks, default=None)
            self._count(rows.where(~late), before, batch_id)
            closed = F.col("window_end") <= F.timestamp_micros(F.lit(watermark).cast("long"))
            alerts = self._counts(spark, batch_id).where(closed)
            alerts = alerts.where(F.col("event_count") > self.threshold)
            self._write(alerts, ALERTS, batch_id)
            # Written last: with this row the batch is done.
            row = spark.createDataFrame([(batch_id, watermark, n_rows, n_late, version)], NOTED)
            row = row.withColumn("watermark", F.timestamp_micros("watermark")).coalesce(1)
            self._write(row, "_progress", batch_id)
            remove_path(spark, f"{self.path}/_windows/batch={batch_id - 2}")
        finally:
            batch.unpersist()

    def before(self, spark: SparkSession, batch_id: int) -> dict | None:
        """What the last batch before this one left behind."""
        if batch_id == 0:
            return None
        row = spark.read.schema(PROGRESS).parquet(f"{self.path}/_progress/batch={batch_id - 1}")
        return row.withColumn("watermark", F.unix_micros("watermark")).first().asDict()

    def _count(self, rows: DataFrame, before: dict | None, batch_id: int) -> None:
        """Add the batch's rows to the windows that are still open."""
        fresh = rows.select(
            "user_id",
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            F.lit(1).cast("long").alias("event_count"),
        )
        if before:
            kept = self._counts(rows.sparkSession, batch_id - 1)
            if before["watermark"] is not None:
                passed = F.timestamp_micros(F.lit(before["watermark"]))
                kept = kept.where(F.col("window_end") > passed)
            fresh = fresh.unionByName(kept)
        summed = fresh.groupBy("user_id", "window_start", "window_end").agg(
            F.sum("event_count").alias("event_count")
        )
        self._write(summed, "_windows", batch_id)

    def _counts(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/_windows/batch={batch_id}")

    def _lists(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, str | None]:
        """The lists and, if they are published, the version this batch started with."""
        if isinstance(self.recs, DataFrame):
            return self.recs, None
        pin = f"{self.path}/_versions/batch={batch_id}"
        if not exists(spark, f"{pin}/_SUCCESS"):
            latest = model_info(spark, self.recs, schemas.LISTS_METADATA).first()
            if latest is None or latest["version"] is None:
                raise ValueError(f"no lists are published at {self.recs}")
            row = spark.createDataFrame([(latest["version"],)], "version string")
            self._write(row.coalesce(1), "_versions", batch_id)
        version = spark.read.schema("version string").parquet(pin).first()["version"]
        parts, _ = load_version(
            spark, self.recs, ["lists"], schemas.LISTS_METADATA, version=version
        )
        return parts["lists"], version

    def _write(self, rows: DataFrame, sink: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{sink}/batch={batch_id}")


def read_sink(spark: SparkSession, path: str, sink: str) -> DataFrame:
    """All rows of a sink, with the number of the batch that wrote them as ``batch``."""
    return spark.read.parquet(f"{path}/{sink}")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished batch: watermark, rows, late rows, version of the lists."""
    return spark.read.schema(PROGRESS).parquet(f"{path}/_progress")


def start_fan_out(
    events: DataFrame,
    recs: DataFrame | str,
    path: str,
    checkpoint: str,
    interval: str = INTERVAL,
    drain: bool = False,
    **options,
) -> StreamingQuery:
    """Alerts, recommendations and late rows of a stream that is read once.

    ``recs`` are user lists, or the path where ``publish_lists`` stores them;
    ``options`` are those of ``FanOut``. ``more`` names further sinks, each a function
    of the batch.
    """
    deal = FanOut(path, recs, **options)
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(deal)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()
