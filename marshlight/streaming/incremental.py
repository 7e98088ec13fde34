"""Load only the periods a table lacks, or replace them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import path_exists


def missing_periods(batch: DataFrame, existing: DataFrame, period: str = "PE") -> DataFrame:
    """Rows of `batch` whose period is not yet in `existing`.

    Only the distinct periods of `existing` take part, a list as long as the calendar; on a table
    partitioned by period they come from directory names.
    """
    return batch.join(existing.select(period).distinct(), period, "left_anti")


def load_periods(spark: SparkSession, batch: DataFrame, path: str, period: str = "PE",
                 overwrite: bool = False) -> None:
    """Append new periods to the table at `path`; with `overwrite`, replace the periods in `batch`."""
    if not path_exists(spark, path):
        batch.write.partitionBy(period).parquet(path)
        return
    if overwrite:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(period).parquet(path))
        return
    typed = F.col(period).cast(dict(spark.read.parquet(path).dtypes)[period])
    fresh = missing_periods(batch.withColumn(period, typed), spark.read.parquet(path), period)
    fresh.write.mode("append").partitionBy(period).parquet(path)
