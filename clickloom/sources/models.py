"""Models as tables: factor rows per version plus one metadata row each.

Vectors are written first and the metadata row last, so a version is visible
only when it is whole.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.sources.files import exists


def save_version(
    spark: SparkSession,
    path: str,
    parts: dict[str, DataFrame],
    metadata: dict,
    metadata_schema: T.StructType,
) -> str:
    """Write the parts of a new version, then publish its metadata row."""
    version = uuid.uuid4().hex
    for name, df in parts.items():
        df.write.parquet(f"{path}/versions/{version}/{name}")
    row = {
        **metadata,
        "version": version,
        "last_updated": metadata.get("last_updated") or datetime.now(UTC).replace(tzinfo=None),
    }
    values = [tuple(row.get(f.name) for f in metadata_schema.fields)]
    spark.createDataFrame(values, metadata_schema).coalesce(1).write.mode("append").parquet(
        f"{path}/metadata"
    )
    return version


def model_info(
    spark: SparkSession, path: str, metadata_schema: T.StructType, **wanted
) -> DataFrame:
    """Metadata of the latest version (with the values ``wanted``), as one row."""
    rows = spark.read.schema(metadata_schema).parquet(f"{path}/metadata")
    for name, value in wanted.items():
        rows = rows.where(F.col(name) == F.lit(value))
    latest = rows.agg(F.max_by(F.struct("*"), F.struct("last_updated", "version")).alias("m"))
    return latest.select("m.*")


def model_versions(spark: SparkSession, path: str, metadata_schema: T.StructType) -> DataFrame:
    """All versions, newest first."""
    rows = spark.read.schema(metadata_schema).parquet(f"{path}/metadata")
    return rows.orderBy(F.col("last_updated").desc(), F.col("version").desc())


def load_version(
    spark: SparkSession, path: str, parts: list[str], metadata_schema: T.StructType, **wanted
) -> tuple[dict[str, DataFrame], dict] | None:
    """Parts and metadata of the latest version; None when no model is stored.

    ``wanted`` narrows the choice to versions with these metadata values.
    """
    if not exists(spark, f"{path}/metadata"):
        return None
    row = model_info(spark, path, metadata_schema, **wanted).first()
    if row is None or row["version"] is None:
        return None
    metadata = row.asDict()
    base = f"{path}/versions/{metadata['version']}"
    return {name: spark.read.parquet(f"{base}/{name}") for name in parts}, metadata
