"""Writing tables. Plain Spark writers: the committer makes a lost executor's retry safe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet or csv by extension, replacing what is there."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ext == "parquet":
        writer.parquet(path)
    elif ext == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported file type: {path}")


def write_per_year(df: DataFrame, path: str, year: str = "YEAR") -> None:
    """One directory per year, written in one pass."""
    df.write.mode("overwrite").partitionBy(year).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table whose later joins and windows on `key` need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def push_to_database(df: DataFrame, table: str, url: str | None = None, **options: str) -> None:
    """To a JDBC database when a url is given, else to a catalog table of that name."""
    if url is None:
        df.write.mode("overwrite").saveAsTable(table)
    else:
        df.write.mode("overwrite").format("jdbc").options(url=url, dbtable=table, **options).save()
