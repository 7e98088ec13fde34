"""Reading tables: by file type, by latest version, by country, with required columns checked."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.geo import parse_point
from ..operators.shape import cast_columns, require, union_all

POINT_SCHEMA = "type string, features array<struct<properties: map<string,string>, geometry: string>>"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               null_value: str = "") -> DataFrame:
    """Format by extension: parquet, csv, json (lines) or geojson; anything else is an error."""
    ext = path.rstrip("/*").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None or ext == "geojson" else spark.read.schema(schema)
    if ext == "parquet":
        return reader.parquet(path)
    if ext == "csv":
        return reader.option("header", True).option("nullValue", null_value).csv(path)
    if ext == "json":
        return reader.json(path)
    if ext == "geojson":
        return read_features(spark, path)
    raise ValueError(f"unsupported file type: {path}")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features: `properties` as a map and the geometry as text, one row per feature."""
    doc = spark.read.schema(POINT_SCHEMA).option("multiLine", True).json(path)
    return doc.select(F.explode("features").alias("f")).select(
        F.col("f.properties").alias("PROPERTIES"), F.col("f.geometry").alias("GEOMETRY")
    )


def latest_version(df: DataFrame, version: str = "version") -> DataFrame:
    """Rows of the highest version; on a table partitioned by version only that partition is read."""
    return df.filter(F.col(version) == df.agg(F.max(version)).scalar())


def read_country_table(spark: SparkSession, root: str, country: str, suffix: str, label: str,
                       required: Sequence[str] = (), types: Mapping[str, str] | None = None) -> DataFrame:
    """`<root>/<country><suffix>`; the error names the table when it is absent or lacks a column."""
    path = f"{root.rstrip('/')}/{country}{suffix}"
    try:
        df = read_table(spark, path)
    except Exception as err:
        raise FileNotFoundError(f"could not load {label} for {country}: {path}") from err
    return cast_columns(require(df, required, label), types or {})


def read_variant(spark: SparkSession, path: str, variant: str) -> DataFrame:
    """One variant (raw, imputed, without outliers, ...) of a routine table partitioned by `variant`.

    Only that partition is read; a variant that is not there is an error.
    """
    df = spark.read.parquet(path)
    rows = require(df, ["variant"], "routine variants").filter(F.col("variant") == variant)
    if not rows.inputFiles() or rows.isEmpty():
        raise FileNotFoundError(f"no variant {variant!r} in {path}")
    return rows.drop("variant")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_first_available(spark: SparkSession, paths: Iterable[str | None]) -> DataFrame | None:
    """The first existing table of a preference list, or None so the caller skips its step."""
    for path in paths:
        if path and path_exists(spark, path):
            return read_table(spark, path)
    return None


def merge_period_files(spark: SparkSession, glob: str) -> DataFrame:
    """All period files as one table: unreadable files skipped (`period_file_ledger` names them), columns in upper case."""
    df = _readable(spark, glob)
    return df.toDF(*[c.upper() for c in df.columns])


def _readable(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(glob)


def period_file_ledger(spark: SparkSession, glob: str, level: int = -1) -> DataFrame:
    """file, bytes, n_rows, merged of every file of the glob, beside the table of `merge_period_files`.

    `level` is the part of the path that names the file (-2 for files that are folders of parts). merged is false where no row came from the file: it is broken or has no rows. The listing reads no contents; rows are
    counted by file from the footers' tables, so one small aggregate is all that moves.
    """
    listed = spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("bytes"))
    gave = _readable(spark, glob).groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("n_rows"))
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "%20", " "), "^file:/*", "/")
    out = listed.join(gave, plain(F.col("path")) == plain(F.col("_path")), "left")
    return out.select(F.element_at(F.split("path", "/"), level).alias("file"), "bytes", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      F.col("n_rows").isNotNull().alias("merged"))


def concat_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return union_all([read_table(spark, p) for p in paths])


def facility_points(df: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """Check the shape of a user's facility list: one latitude and one longitude column, any case.

    Type problems cannot be seen without reading the rows: `bad_coordinates` counts them.
    """
    found = {}
    for want in (lat, lon):
        hits = [c for c in df.columns if c.upper() == want.upper()]
        if len(hits) != 1:
            raise ValueError(f"exactly one {want} column is needed, found {len(hits)}")
        found[hits[0]] = want
    return df.withColumnsRenamed(found)


def bad_coordinates(df: DataFrame, cols: Sequence[str] = ("LATITUDE", "LONGITUDE")) -> DataFrame:
    """One row: number of values per column that are present but not numeric."""
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull()).alias(c)
        for c in cols
    ])


def facility_list(spark: SparkSession, user_path: str | None, pyramid: DataFrame) -> DataFrame:
    """The user's csv when it is usable, else the points of the pyramid."""
    if user_path and user_path.lower().endswith(".csv") and path_exists(spark, user_path):
        try:
            points = facility_points(read_table(spark, user_path))
        except ValueError:
            return pyramid
        bad = bad_coordinates(points).first()  # one row of two counts
        if bad["LATITUDE"] == 0 and bad["LONGITUDE"] == 0:
            return cast_columns(points, {"LATITUDE": "double", "LONGITUDE": "double"})
    return pyramid


def cell_table(df: DataFrame, lon: str, lat: str, value: str, nodata: float | None = None,
               extra: Sequence[str | Column] = ()) -> DataFrame:
    """Gridded values as rows (lon, lat, value), the grid's no-data mark turned into null."""
    v = F.col(value).cast("double")
    if nodata is not None:
        v = F.when(v != nodata, v)
    return df.select(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat"), *extra,
                     v.alias("value"))


def with_point_columns(df: DataFrame, geometry: str = "GEOMETRY") -> DataFrame:
    """LONGITUDE and LATITUDE read from point text, which is then dropped."""
    point = parse_point(geometry)
    return df.withColumns({"LONGITUDE": point["lon"], "LATITUDE": point["lat"], "PARSE_OK": point["parse_ok"]}
                          ).drop(geometry)


# Fixed value: gridded metric files are named <Category>__<Version>_<Region>_<Indicator>_<Year>.tif
METRIC_FILE = r"([A-Za-z]+)__([0-9]{6})_(Global|Africa)_(.+?)_(\d{4})\.tif$"


def metric_from_file_name(df: DataFrame, path: str = "path") -> DataFrame:
    """Category, version, region, indicator and year of a metric file; another name raises at run time.

    Works on a table of names or on `input_file_name()`.
    """
    name = F.when(F.col(path).rlike(METRIC_FILE), F.col(path)).otherwise(
        F.raise_error(F.concat(F.lit("cannot parse file name: "), F.col(path)))
    )
    part = {c: F.regexp_extract(name, METRIC_FILE, i) for i, c in
            enumerate(["METRIC_CATEGORY", "VERSION", "REGION", "METRIC_NAME", "YEAR"], start=1)}
    part["YEAR"] = part["YEAR"].cast("int")
    return df.withColumns(part)


def version_number(name: Column | str) -> Column:
    """All digits of a file name as one number."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(c, r"\D", "").try_cast("bigint")


def latest_named(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Of the names matching `pattern`, those with the highest number in them."""
    hits = df.filter(F.col(name).rlike(pattern)).withColumn("_v", version_number(name))
    best = hits.agg(F.max("_v")).scalar()
    return hits.filter(F.col("_v") == best).drop("_v")
