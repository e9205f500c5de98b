"""Regression errors, row counts per step, feature importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def absolute_error(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Adds |prediction - label| * 100."""
    return df.withColumn("absolute_error_pct",
                         F.abs(F.col(prediction) - F.col(label)) * 100.0)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with the mean absolute, mean squared and root mean squared error."""
    error = F.col(prediction) - F.col(label)
    squared = F.avg(error * error)
    return df.agg(F.avg(F.abs(error)).alias("mae"), squared.alias("mse"),
                  F.sqrt(squared).alias("rmse"))


def count_rows(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while some later action reads them."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def feature_importance(spark, features: Sequence[str], values: Sequence[float]) -> DataFrame:
    """(feature, importance) in ascending order; one row per feature."""
    rows = [(f, float(v)) for f, v in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        "importance", "feature")
