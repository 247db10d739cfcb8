"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import materialize

ID, TEXT = "doc_id", "text"
BROADCAST_ROWS = 1_000_000  # of an id or two
ARROW_ROWS = 2_000  # of a batch between a task and its Python worker


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = TEXT) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the folds of the learned operators."""
    text = F.col(id_col).cast("string")
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(modulus)).cast("int")


def bounded(frame: DataFrame) -> DataFrame:
    """A narrow frame, to be broadcast if it is counted to be small; else as it is."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def drop_listed(
    docs: DataFrame, dropped: DataFrame, content: Column, id_col: str = ID
) -> DataFrame:
    """``docs`` without the rows whose id and content are listed; rows without id stay.

    ``dropped`` has the id and the ``content`` (a hash of the text) of each row to go, so
    another text of the same id stays. A list of at most ``BROADCAST_ROWS`` ids is
    broadcast and no text is shuffled; with a longer one it is a plain anti join. Only
    texts of listed ids are hashed.
    """
    ids, contents = dropped.columns
    listed = materialize(
        dropped.where(F.col(ids).isNotNull())
        .groupBy(F.col(ids).alias("_listed"))
        .agg(F.collect_set(contents).alias("_contents")),
        "dropped",
    )
    same = (docs[id_col] == listed["_listed"]) & F.array_contains(listed["_contents"], content)
    return docs.join(bounded(listed), same, "left_anti")


def in_arrow(rows: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``ARROW_ROWS`` rows, for rows with whole texts.

    Executor and worker each hold a batch; at Spark's default of 10,000 rows that is often
    all of a task's input. A smaller setting of the session stays.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= ARROW_ROWS:
        conf.set(name, ARROW_ROWS)
    return rows.mapInArrow(released(run), schema)


def released(run):
    """``run`` of ``mapInArrow``; when a task ends, unused memory goes back to the system.

    Workers live on and take other tasks; what their pools keep adds up.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(AttributeError, OSError):  # only some C libraries have it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped
