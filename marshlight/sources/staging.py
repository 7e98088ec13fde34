"""Intermediate tables that several later steps read.

A job that needs one derived table more than once writes it to the cluster's shared folder and reads it
back: the facts are scanned once, later steps read only the columns they use, the optimizer knows the real
size, and a lost executor costs no recomputation of what came before.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, or the session's warehouse where that is unset.

    Every executor must reach it, so on a cluster a warehouse on a local disk is refused: set one of the two.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            if path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file":
                raise ValueError("set spark.checkpoint.dir (or a shared spark.sql.warehouse.dir): executors do not share " + root)
    return root.rstrip("/")


def _app_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/marshlight-{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it when its last result is written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_app_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_path(spark: SparkSession) -> str:
    """A place of its own among what this application stages."""
    return f"{_app_folder(spark)}/{uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back, in every mode of running.

    Its shuffle files are deleted once it is written, since nothing reads them any more.
    """
    spark = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
