"""Gridded climate, population and risk data by district."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import ratio
from ..functions.periods import epi_week, iso_week, month_key
from ..operators.spatial import all_shapes, zonal

STATS = ("MEAN", "MIN", "MAX")


def district_cells(cells: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """The fixed cell to district table: cell centres by containment. Write it once, use it for every year."""
    centres = cells.select("lon", "lat").distinct()
    return all_shapes(centres, edges, ["ADM2_ID"], size, x="lon", y="lat")


def on_districts(values: DataFrame, district_cell: DataFrame) -> DataFrame:
    return values.join(district_cell, ["lon", "lat"])


def daily_accumulated(values: DataFrame) -> DataFrame:
    """Accumulated variables: mean, least and largest over the district's cells per time step, summed per day."""
    steps = values.groupBy("ADM2_ID", "ts").agg(F.avg("value").alias("m"), F.min("value").alias("lo"),
                                                F.max("value").alias("hi"))
    return steps.groupBy("ADM2_ID", F.to_date("ts").alias("DATE")).agg(
        F.sum("m").alias("MEAN"), F.sum("lo").alias("MIN"), F.sum("hi").alias("MAX"))


def daily_average(values: DataFrame) -> DataFrame:
    """Other variables: mean, least and largest of each cell's day, averaged over the district."""
    per_cell = values.groupBy("ADM2_ID", "lon", "lat", F.to_date("ts").alias("DATE")).agg(
        F.avg("value").alias("m"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return per_cell.groupBy("ADM2_ID", "DATE").agg(
        F.avg("m").alias("MEAN"), F.avg("lo").alias("MIN"), F.avg("hi").alias("MAX"))


def daily_average_of_cells(values: DataFrame, district_cell: DataFrame) -> DataFrame:
    """`daily_average` from gridded steps (lon, lat, ts, value): each cell's day is reduced before it meets its district."""
    per_cell = values.groupBy("lon", "lat", F.to_date("ts").alias("DATE")).agg(
        F.avg("value").alias("m"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return on_districts(per_cell, district_cell).groupBy("ADM2_ID", "DATE").agg(
        F.avg("m").alias("MEAN"), F.avg("lo").alias("MIN"), F.avg("hi").alias("MAX"))


def in_units(daily: DataFrame, scale: float = 1.0, offset: float = 0.0) -> DataFrame:
    """Kelvin to Celsius is offset -273.15, metres to millimetres scale 1000."""
    return daily.withColumns({c: F.col(c) * scale + offset for c in STATS})


def daily_table(values: DataFrame, accumulated: bool, scale: float = 1.0, offset: float = 0.0) -> DataFrame:
    daily = in_units(daily_accumulated(values) if accumulated else daily_average(values), scale, offset)
    return daily.filter("MEAN is not null and DATE is not null").withColumns(
        {"WEEK": iso_week("DATE"), "PERIOD": month_key("DATE"), "EPI_WEEK": epi_week("DATE")})


def by_period(daily: DataFrame, key: str, accumulated: bool) -> DataFrame:
    """Daily rows to weeks, epidemiological weeks or months: sums of accumulated variables, else means."""
    how = F.sum if accumulated else F.avg
    return daily.groupBy("ADM2_ID", key).agg(*[how(c).alias(c) for c in STATS])


def month_columns(monthly: DataFrame) -> DataFrame:
    return monthly.withColumns({"YEAR": F.substring("PERIOD", 1, 4).cast("int"),
                                "MONTH": F.substring("PERIOD", 5, 2).cast("int")})


def district_population(cells: DataFrame, district_cell: DataFrame, keys: Sequence[str] = ("YEAR",)) -> DataFrame:
    """Population and number of cells by district (and year)."""
    return zonal(on_districts(cells, district_cell), ["ADM2_ID", *keys]).select(
        "ADM2_ID", *keys, F.col("total").alias("POPULATION"), F.col("cells").alias("CELLS"))


# Grid band to statistic name.
BANDS = {"Data": "MEAN", "LCI": "LCI", "UCI": "UCI", "GRAY_INDEX": "MEAN"}


def metric_means(cells: DataFrame, district_cell: DataFrame) -> DataFrame:
    """Mean of each band over the district, long form by metric and year."""
    bands = F.create_map(*[F.lit(x) for kv in BANDS.items() for x in kv])
    named = on_districts(cells, district_cell).withColumn(
        "STATISTIC", F.coalesce(F.try_element_at(bands, F.col("band")), F.col("band")))
    return named.groupBy("ADM2_ID", "metric", "year", "STATISTIC").agg(F.avg("value").alias("VALUE"))


def weighted_metric(aligned: DataFrame, district_cell: DataFrame, population: str = "population",
                    value: str = "value") -> DataFrame:
    """Population-weighted sum and rate by district: cells without metric or population do not count in the sum."""
    df = on_districts(aligned, district_cell)
    sums = df.groupBy("ADM2_ID").agg(
        F.sum(F.col(population) * F.col(value)).alias("WEIGHTED_SUM"),
        F.bround(F.sum(population), 0).alias("POPULATION"))
    return sums.withColumn("POPULATION_WEIGHTED", ratio("WEIGHTED_SUM", "POPULATION"))
