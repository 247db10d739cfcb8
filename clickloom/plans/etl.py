"""Typed ETL of users and products into catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.times import to_date, to_double
from clickloom.sources.readers import read_csv
from clickloom.sources.tables import use_namespace, write_table

NAMESPACE = "demo"


def typed_users(users: DataFrame) -> DataFrame:
    return users.withColumn("signup_date", to_date(F.col("signup_date")))


def typed_products(products: DataFrame) -> DataFrame:
    return products.withColumn("price", to_double(F.col("price")))


def etl_users(
    spark: SparkSession, csv_path: str, table: str, path: str | None = None
) -> DataFrame:
    """One scan of the file: the schema is given and rows are not counted first."""
    return write_table(typed_users(read_csv(spark, csv_path, schemas.USERS_CSV)), table, path)


def etl_products(
    spark: SparkSession, csv_path: str, table: str, path: str | None = None
) -> DataFrame:
    return write_table(
        typed_products(read_csv(spark, csv_path, schemas.PRODUCTS_CSV)), table, path
    )


def run_etl(
    spark: SparkSession, users_csv: str, products_csv: str, namespace: str = NAMESPACE
) -> tuple[DataFrame, DataFrame]:
    use_namespace(spark, namespace)
    return (
        etl_users(spark, users_csv, f"{namespace}.users"),
        etl_products(spark, products_csv, f"{namespace}.products"),
    )
