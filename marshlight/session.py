"""Session settings for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the runtime work this library relies on: it turns a join into a broadcast
# join only after it has measured the small side, splits skewed join partitions and merges tiny ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a running session is reused."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marshlight")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
