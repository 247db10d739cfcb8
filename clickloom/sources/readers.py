"""CSV and JSON-lines readers, bounded and unbounded."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions.times import parse_event_time

# Matches the full path, so files below a folder with such a name count too.
CLICKSTREAM_PATHS = r"clickstream.*\.json"
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header. Without a schema all columns are text unless ``infer`` is set.

    Quoted fields may hold commas and doubled quotes (the vector columns do).
    """
    reader = spark.read.option("header", "true").option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", str(infer).lower()).csv(path)


def _json_options(reader, schema: T.StructType, bad_records: str):
    if bad_records == "drop":
        return reader.schema(schema).option("mode", "DROPMALFORMED")
    if bad_records == "fail":
        return reader.schema(schema).option("mode", "FAILFAST")
    if bad_records == "null":
        kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return (
            reader.schema(kept)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
        )
    raise ValueError(f"unknown bad_records: {bad_records}")


def read_json_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    bad_records: str = "drop",
    file_glob: str | None = None,
    path_pattern: str | None = None,
) -> DataFrame:
    """JSON lines from one or many paths; blank lines are skipped.

    All files of the paths are read unless ``file_glob`` (file names) or
    ``path_pattern`` (a regular expression found in the full path) says
    otherwise. Paths that leave no file to read are an error.

    ``bad_records``: ``drop`` a broken line, keep it as a ``null`` row with its
    text in ``_corrupt_record``, or ``fail``. Without a schema Spark infers one,
    which costs a pass over the files.
    """
    reader = spark.read
    if schema is not None:
        reader = _json_options(reader, schema, bad_records)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    places = [paths] if isinstance(paths, str) else list(paths)
    if not any(_has_input(spark, place, file_glob, path_pattern) for place in places):
        raise FileNotFoundError(f"no input files in {paths}")
    rows = reader.json(places)
    if path_pattern is not None:
        rows = rows.where(F.url_decode("_metadata.file_path").rlike(path_pattern))
    return rows


def _has_input(
    spark: SparkSession, path: str, file_glob: str | None, path_pattern: str | None
) -> bool:
    """Whether a file to read is at or below ``path``; the listing stops at the first one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = hadoop.GlobPattern(file_glob) if file_glob else None
    for status in fs.globStatus(place) or []:
        root = unquote(status.getPath().toString())
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            found = files.next().getPath()
            full, name = unquote(found.toString()), found.getName()
            hidden = any(part[:1] in ("_", ".") for part in full[len(root) :].split("/"))
            if hidden or (named and not named.matches(name)):
                continue
            if path_pattern is None or re.search(path_pattern, full):
                return True
    return False


def count_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType
) -> tuple[int, int]:
    """Readable and broken lines: what reading with ``drop`` would keep and lose."""
    broken = F.col(CORRUPT).isNotNull()
    rows = read_json_lines(spark, paths, schema, bad_records="null")
    # The hash makes all columns take part: a pruned read takes broken lines for whole.
    good, bad, _ = rows.agg(
        F.count_if(~broken), F.count_if(broken), F.max(F.xxhash64(*schema.fieldNames()))
    ).first()
    return good, bad


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first path that exists; the inputs of a job may be in one of several places.

    A candidate may be a glob; then it counts if it matches anything.
    """
    for path in candidates:
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.globStatus(hadoop_path):
            return path
    raise FileNotFoundError(f"none of {list(candidates)} exists")


def with_event_time(df: DataFrame, mode: str = "lenient") -> DataFrame:
    return df.withColumn("event_time", parse_event_time(F.col("timestamp"), mode))


def read_clickstream(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_glob: str | None = None,
    bad_records: str = "drop",
    mode: str = "lenient",
    path_pattern: str | None = None,
) -> DataFrame:
    """Bounded click events with their computed event time.

    ``path_pattern=CLICKSTREAM_PATHS`` picks the clickstream out of a mixed folder.
    """
    df = read_json_lines(
        spark, paths, schemas.CLICKSTREAM, bad_records, file_glob, path_pattern
    )
    return with_event_time(df, mode)


def read_clickstream_stream(
    spark: SparkSession,
    path: str,
    file_glob: str | None = None,
    bad_records: str = "drop",
    mode: str = "lenient",
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Unbounded click events from a watched directory. How often it is polled is the
    trigger of the query that reads it. Files of finished batches move to ``archive_dir``."""
    reader = _json_options(spark.readStream, schemas.CLICKSTREAM, bad_records)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return with_event_time(reader.json(path), mode)


def inspect(df: DataFrame, n: int = 5) -> tuple[int, str, DataFrame]:
    """Row count, schema text and the first ``n`` rows."""
    return df.count(), df.schema.simpleString(), df.limit(n)
