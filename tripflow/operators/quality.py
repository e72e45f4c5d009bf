"""Counts that describe a batch or a zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns() -> list[Column]:
    """Total, valid and rejected records: aggregates for one pass over the records, alone or observed during a write."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("rejected"),
    ]


def batch_metrics(validated: DataFrame) -> DataFrame:
    return validated.agg(*metric_columns())


def rejection_summary(rejected: DataFrame, by: tuple[str, ...] = ("ingestion_date", "validation_error")) -> DataFrame:
    return rejected.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))
