"""Catalog tables, namespaces and views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.sources.files import remove_path

FORMAT = "parquet"
# Table property that lists the folders of a table's versions, the current one last.
VERSIONS = "clickloom.versions"


def _session_catalog(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    catalog = parts[0] if len(parts) == 3 else spark.catalog.currentCatalog()
    return catalog == "spark_catalog"


def use_namespace(spark: SparkSession, name: str, create: bool = True) -> None:
    """Create the namespace if missing and make it current."""
    if create:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a table and return a scan of it.

    A lakehouse catalog replaces the table atomically. In the session catalog every
    version is a Parquet folder of its own, below ``path`` or the namespace's folder.
    The new version is written first and the table then pointed at it, so a failed
    write leaves the old rows; the version before stays until the next replacement,
    so readers that began on it end on it. A version with other columns is a new
    table: it is missing for the moment between dropping and creating it.
    """
    spark = df.sparkSession
    if not _session_catalog(spark, name):
        df.writeTo(name).createOrReplace()
        return spark.table(name)
    root = (path or _default_root(spark, name)).rstrip("/")
    target = f"{root}/version-{uuid.uuid4().hex}"
    df.write.format(FORMAT).save(target)
    schema = spark.read.format(FORMAT).load(target).schema
    before = _versions(spark, name)
    if spark.catalog.tableExists(name):
        if _columns(spark.table(name).schema) == _columns(schema):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
            spark.catalog.refreshTable(name)
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, target, FORMAT, schema)
    current = before[-1:]
    kept = ",".join([*current, target])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSIONS}' = '{kept}')")
    for old in before[:-1]:
        remove_path(spark, old)
    return spark.table(name)


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def _default_root(spark: SparkSession, name: str) -> str:
    *namespace, table = name.split(".")
    place = spark.catalog.getDatabase(namespace[-1] if namespace else spark.catalog.currentDatabase())
    return f"{place.locationUri}/{table}-versions"


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The folders that ``write_table`` keeps for a table: the version before, and the current."""
    if not spark.catalog.tableExists(name):
        return []
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == VERSIONS).collect()
    return rows[0]["value"].split(",") if rows else []


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None
) -> DataFrame:
    """Create the table with a fixed schema unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if _session_catalog(spark, name):
        where = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {FORMAT}{where}")
    else:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING iceberg "
            "TBLPROPERTIES ('format-version' = '2')"
        )
    return spark.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """Append rows; columns are matched by name."""
    table = df.sparkSession.table(name)
    df.select(table.columns).write.mode("append").insertInto(name)
    return df.sparkSession.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table, with the versions that ``write_table`` keeps."""
    folders = _versions(spark, name) if _session_catalog(spark, name) else []
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for folder in folders:
        remove_path(spark, folder)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}" if namespace else "SHOW TABLES")


def register_view(name: str, df: DataFrame) -> None:
    df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, statement: str, **views: DataFrame) -> DataFrame:
    """Run one statement over the catalog and the given views."""
    for name, df in views.items():
        register_view(name, df)
    return spark.sql(statement)
