"""Training runs of the sequence model over staged files: full, incremental or nothing to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import normalize_timestamp
from clickloom.plans import sequence_model as seq
from clickloom.schemas import CLICKSTREAM
from clickloom.session import materialize
from clickloom.sources.files import archive, has_new_data, move_back
from clickloom.sources.readers import read_json_lines

ROW = "_row"


def training_events(spark: SparkSession, path: str) -> DataFrame:
    """Click events with ISO or epoch times; rows keep file order where time is equal or missing.

    File order is that of path and block, however the files are packed into tasks.
    A broken line fails the run. Training scans its events several times, so the
    text is parsed once and kept as a table.
    """
    rows = read_json_lines(spark, path, CLICKSTREAM, bad_records="fail")
    events = rows.select(
        "user_id",
        "product_id",
        normalize_timestamp(F.col("timestamp")).alias("event_time"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ROW),
    )
    return materialize(events, "training-events")


def run_training(
    spark: SparkSession,
    clickstream_path: str,
    model_path: str,
    incremental: bool = False,
    new_path: str | None = None,
    archive_dir: str | None = None,
    epochs: int | None = None,
    **training,
) -> dict:
    """Train, save and archive.

    An incremental run without a stored model trains in full. With a model but
    no new data it reports ``noop`` and writes nothing. With ``archive_dir`` new
    data moves there before it is read, so what arrives meanwhile waits for the
    next run; a failed run moves it back.
    """
    limit = {} if epochs is None else {"epochs": epochs}
    known = seq.load_model(spark, model_path) if incremental else None
    if known is None:
        model = seq.train_sequence_model(
            training_events(spark, clickstream_path), tie_cols=(ROW,), **limit, **training
        )
        version = seq.save_model(model, model_path)
        return {"mode": "full", "version": version, "archived": None, **_summary(model)}
    if new_path is None or not has_new_data(spark, new_path):
        return {"mode": "noop", "version": None, "archived": None, **_summary(known)}
    archived = archive(spark, new_path, archive_dir) if archive_dir else None
    try:
        model = seq.update_sequence_model(
            known, training_events(spark, archived or new_path), tie_cols=(ROW,), **limit, **training
        )
        version = seq.save_model(model, model_path)
    except Exception:
        if archived:
            move_back(spark, archived, new_path)
        raise
    return {"mode": "incremental", "version": version, "archived": archived, **_summary(model)}


def _summary(model: seq.SequenceModel) -> dict:
    keys = ("n_users", "n_items", "epochs_completed", "final_loss", "total_training_samples")
    return {key: model.metadata[key] for key in keys}
