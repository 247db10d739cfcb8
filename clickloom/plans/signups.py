"""Monthly signups of users that were never flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.times import month_of, to_date
from clickloom.operators.keys import exclude_fraud
from clickloom.sources.files import write_json


def legit_signups_by_month(users: DataFrame, fraud: DataFrame) -> DataFrame:
    month = month_of(to_date(F.col("signup_date"))).alias("signup_month")
    return (
        exclude_fraud(users, fraud)
        .groupBy(month)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def export_signups(users: DataFrame, fraud: DataFrame, path: str) -> None:
    write_json(legit_signups_by_month(users, fraud), path)
