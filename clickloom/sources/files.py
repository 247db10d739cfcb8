"""Staging, merging, listing and archiving of dataset files.

Rows move through Spark readers and writers; only names and sizes are handled
on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.session import scratch_root
from clickloom.sources.readers import read_csv

GROUPS = ("users", "products", "clickstream")
ARCHIVE_STAMP = "%Y%m%d_%H%M%S"
ARCHIVE_NAME = "clickstream_archive_"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted by name."""
    fs, hadoop_path = _fs(spark, pattern)
    return sorted(str(s.getPath()) for s in (fs.globStatus(hadoop_path) or []))


def write_json(df: DataFrame, path: str) -> None:
    """JSON records, one per line."""
    df.write.mode("overwrite").json(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as JSON text in the column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def has_new_data(spark: SparkSession, path: str) -> bool:
    """Whether a non-blank line waits at ``path``; stops at the first one."""
    if not exists(spark, path):
        return False
    return not spark.read.text(path).filter(F.trim("value") != "").isEmpty()


def check_new_data(spark: SparkSession, path: str) -> int | None:
    """Number of non-blank lines waiting at ``path``; None when nothing is there."""
    if not exists(spark, path):
        return None
    return spark.read.text(path).filter(F.trim("value") != "").count()


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Non-blank lines, stripped, with the name and path of the file they come from."""
    return (
        spark.read.text(list(paths))
        .select(
            F.trim("value").alias("value"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_path").alias("source"),
        )
        .filter(F.col("value") != "")
    )


def merge_clickstream(spark: SparkSession, paths: Sequence[str], out: str) -> DataFrame:
    """Merge JSON-lines files into one dataset, lines unchanged and blank ones left out.

    A line that is not JSON fails the job. Returns a report per input file: name,
    path (``source``), records and the keys of its first record.
    """
    lines = _lines(spark, paths)
    broken = F.try_parse_json("value").isNull()
    message = F.concat(F.lit("not JSON in "), F.col("file"), F.lit(": "), F.col("value"))
    checked = lines.select(
        F.when(broken, F.raise_error(message)).otherwise(F.col("value")).alias("value")
    )
    checked.write.mode("overwrite").text(out)
    return _file_report(lines)


def _file_report(lines: DataFrame) -> DataFrame:
    """Records per input file; files of the same name in different folders stay apart."""
    keys = F.json_object_keys(F.first("value"))
    return lines.groupBy("file", "source").agg(
        F.count(F.lit(1)).alias("records"), keys.alias("sample_keys")
    )


def stage(
    spark: SparkSession,
    source: str,
    target: str,
    groups: Sequence[str] = GROUPS,
    individual: bool = True,
    merged: bool = True,
    clickstream_file: str | None = None,
) -> DataFrame:
    """Copy dataset groups into the staged layout and report what was staged.

    Layout below ``target``: ``users``, ``products``, ``clickstream/individual``
    (one folder per input file) and ``clickstream/merged``. A group with no
    input is skipped.
    """
    done: list[DataFrame] = []

    def staged(group: str, out: str, records: DataFrame) -> None:
        done.append(
            records.select(
                F.lit(group).alias("artifact"), F.lit(out).alias("path"), "file", "source", "records"
            )
        )

    for group in (g for g in ("users", "products") if g in groups):
        path = f"{source}/{group}.csv"
        if exists(spark, path):
            out = f"{target}/{group}"
            schema = schemas.USERS_CSV if group == "users" else schemas.PRODUCTS_CSV
            rows = read_csv(spark, path, schema)
            rows.write.mode("overwrite").option("header", "true").option("escape", '"').csv(out)
            name, place = F.lit(f"{group}.csv").alias("file"), F.lit(path).alias("source")
            staged(group, out, rows.groupBy(name, place).agg(F.count(F.lit(1)).alias("records")))
    if "clickstream" in groups:
        files = matching(spark, f"{source}/{clickstream_file or 'clickstream-*.json'}")
        if files and individual:
            out = f"{target}/clickstream/individual"
            lines = _lines(spark, files)
            lines.drop("source").write.mode("overwrite").partitionBy("file").text(out)
            staged("clickstream", out, _file_report(lines))
        if files and merged:
            out = f"{target}/clickstream/merged"
            staged("clickstream", out, merge_clickstream(spark, files, out))
    if not done:
        return spark.createDataFrame(
            [], "artifact string, path string, file string, source string, records long"
        )
    report = done[0]
    for more in done[1:]:
        report = report.unionByName(more)
    return report


def list_files(
    spark: SparkSession, path: str, file_glob: str | None = None, n: int = 25
) -> DataFrame:
    """The ``n`` newest files below ``path``; their content is never read."""
    files = manifest(spark, path, file_glob)
    return files.orderBy(F.col("modificationTime").desc(), "path").limit(n)


def archive(
    spark: SparkSession, path: str, archive_dir: str, now: datetime | None = None
) -> str:
    """Move input to ``archive_dir`` under a UTC-stamped name of its own."""
    stamp = (now or datetime.now(UTC)).strftime(ARCHIVE_STAMP)
    target = f"{archive_dir}/{ARCHIVE_NAME}{stamp}_{uuid.uuid4().hex[:8]}.json"
    fs, source = _fs(spark, path)
    target_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) or not fs.rename(source, target_path):
        raise OSError(f"could not move {path} to {target}")
    return target


def move_back(spark: SparkSession, archived: str, path: str) -> None:
    """Return an archived input to ``path``; refused where new input waits there."""
    fs, source = _fs(spark, archived)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"could not move {archived} back to {path}")


def list_archives(spark: SparkSession, archive_dir: str) -> DataFrame:
    """Archived inputs, newest first; one listing covers all of them."""
    pattern = f"{archive_dir}/{ARCHIVE_NAME}*"
    if not matching(spark, pattern):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    files = manifest(spark, pattern)
    name = F.regexp_extract("path", f"^(.*/{ARCHIVE_NAME}[^/]*)", 1)
    return (
        files.groupBy(name.alias("path"))
        .agg(F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime"))
        .orderBy(F.col("modificationTime").desc(), F.col("path").desc())
    )


def manifest(spark: SparkSession, path: str, file_glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file below ``path``, listed by Spark's tasks.

    Content is never read. An input without files is an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.load(path).select("path", "length", "modificationTime")


def unseen_files(
    spark: SparkSession, path: str, seen: str, file_glob: str | None = None
) -> DataFrame:
    """The files below ``path`` that the table of seen files lacks, or that changed since."""
    files = manifest(spark, path, file_glob)
    if not exists(spark, seen):
        return files
    keys = ["path", "length", "modificationTime"]
    return files.join(spark.read.parquet(seen).select(keys), keys, "left_anti")


def mark_seen(files: DataFrame, seen: str) -> None:
    """Add ``files`` to the table of seen files, once the work on them is done."""
    files.select("path", "length", "modificationTime").write.mode("append").parquet(seen)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder this package made with ``scratch_path``."""
    if "/clickloom/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it exists."""
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch data of this application; frames read from it become unusable."""
    remove_scratch(spark, scratch_root(spark))
