"""Readers, writers and incremental loading on files."""

import json

import pytest
from pyspark.sql import functions as F

from marshlight.sources import readers, writers
from marshlight.sources.staging import drop_staged, shared_folder, stage
from marshlight.streaming.incremental import load_periods


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), (None, None)], "k string, v double")
    for ext in ("parquet", "csv"):
        path = f"{tmp_path}/t.{ext}"
        writers.write_table(df, path)
        got = readers.read_table(spark, path)
        assert sorted((r.k or "", float(r.v or 0)) for r in got.collect()) == [("", 0.0), ("a", 1.5)]
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.xlsx")
    with pytest.raises(ValueError):
        writers.write_table(df, "x.xlsx")


def test_geojson(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ADM2_ID": "D1"}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}]}
    (tmp_path / "s.geojson").write_text(json.dumps(doc))
    row = readers.with_point_columns(readers.read_table(spark, f"{tmp_path}/s.geojson")).first()
    assert row.PROPERTIES["ADM2_ID"] == "D1" and (row.LONGITUDE, row.LATITUDE) == (1.5, 2.0)


def test_country_table_errors_name_the_table(spark, tmp_path):
    spark.createDataFrame([(1,)], "A int").write.parquet(f"{tmp_path}/XX_t.parquet")
    assert readers.read_country_table(spark, str(tmp_path), "XX", "_t.parquet", "thing", ["A"]).count() == 1
    with pytest.raises(ValueError, match="thing lacks"):
        readers.read_country_table(spark, str(tmp_path), "XX", "_t.parquet", "thing", ["B"])
    with pytest.raises(FileNotFoundError, match="thing for YY"):
        readers.read_country_table(spark, str(tmp_path), "YY", "_t.parquet", "thing")


def test_user_points_or_fall_back(spark, tmp_path):
    pyramid = spark.createDataFrame([("p", 1.0, 2.0)], "OU_ID string, LATITUDE double, LONGITUDE double")
    (tmp_path / "good.csv").write_text("name,latitude,Longitude\na,1.5,2.5\nb,,\n")
    (tmp_path / "text.csv").write_text("name,latitude,Longitude\na,north,2.5\n")
    (tmp_path / "cols.csv").write_text("name,latitude,LATITUDE2\na,1,2\n")
    good = readers.facility_list(spark, f"{tmp_path}/good.csv", pyramid)
    assert [(r.LATITUDE, r.LONGITUDE) for r in good.collect()] == [(1.5, 2.5), (None, None)]
    for bad in ("text.csv", "cols.csv", "absent.csv", "good.txt"):
        assert readers.facility_list(spark, f"{tmp_path}/{bad}", pyramid) is pyramid


def test_period_files_skip_unreadable(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.parquet(f"{tmp_path}/p1")
    spark.createDataFrame([(2,)], "a int").coalesce(1).write.parquet(f"{tmp_path}/p2")
    got = readers.merge_period_files(spark, f"{tmp_path}/p*")
    assert got.columns == ["A", "B"] and got.count() == 2


def test_incremental_load(spark, tmp_path):
    path = f"{tmp_path}/facts"

    def batch(rows):
        return spark.createDataFrame(rows, "OU string, VALUE double, PE int")

    load_periods(spark, batch([("a", 1.0, 200001)]), path)
    load_periods(spark, batch([("a", 9.0, 200001), ("a", 2.0, 200002)]), path)
    assert {(r.PE, r.VALUE) for r in spark.read.parquet(path).collect()} == {(200001, 1.0), (200002, 2.0)}
    load_periods(spark, batch([("a", 9.0, 200001)]), path, overwrite=True)
    assert {(r.PE, r.VALUE) for r in spark.read.parquet(path).collect()} == {(200001, 9.0), (200002, 2.0)}


def test_per_year_and_bucketed(spark, tmp_path):
    df = spark.createDataFrame([(2000, "a", 1.0), (2001, "b", 2.0)], "YEAR int, k string, v double")
    writers.write_per_year(df, f"{tmp_path}/y")
    assert spark.read.parquet(f"{tmp_path}/y").filter("YEAR = 2001").first().k == "b"


def test_latest_names(spark):
    df = spark.createDataFrame([("BFPR62SV.zip",), ("BFPR71SV.ZIP",), ("BFKR99SV.zip",)], "name string")
    assert [r.name for r in readers.latest_named(df, "name", r"(?i)PR.*SV\.zip$").collect()] == ["BFPR71SV.ZIP"]


def test_bad_metric_file_name(spark):
    df = spark.createDataFrame([("nonsense.tif",)], "path string")
    with pytest.raises(Exception, match="cannot parse"):
        readers.metric_from_file_name(df).collect()


def test_stage_uses_the_shared_folder_of_the_session(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert folder and shared_folder(spark) == folder
    df = stage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5 and folder in df.inputFiles()[0]
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert readers.path_exists(spark, path)
    drop_staged(spark)
    assert not readers.path_exists(spark, path)


def test_catalog_table_replaces_what_is_there(spark):
    for n in (3, 2):
        writers.push_to_database(spark.range(n), "outliers_detected")
    assert spark.table("outliers_detected").count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(F.col("id").alias("OU_ID"), (F.col("id") * 2).alias("v"))
        for name in ("facts_a", "facts_b"):
            writers.write_bucketed(df, name, "OU_ID", 4)
        joined = spark.table("facts_a").join(spark.table("facts_b"), "OU_ID")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
