"""Error metrics over (rating, prediction) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def error_metrics(
    scored: DataFrame, actual: str = "rating", predicted: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and row count; the errors are NULL for an empty frame."""
    err = F.col(actual) - F.col(predicted)
    return scored.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


def mean_baseline(train: DataFrame, test: DataFrame, value_col: str = "rating") -> DataFrame:
    """Predict the train mean for every test row."""
    return test.withColumn("prediction", train.select(F.avg(value_col)).scalar())
