"""Share of the population within reach of a health facility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import ratio
from ..functions.text import CLOSED_ANY_CASE
from ..operators.spatial import points_within, within_distance


def active_facilities(facilities: DataFrame, closed_group: DataFrame | None = None) -> DataFrame:
    """Not closed by date, by name, or by membership in the closed group."""
    df = facilities.filter(F.col("CLOSED_DATE").isNull() & ~F.coalesce(F.col("OU_NAME").rlike(CLOSED_ANY_CASE),
                                                                      F.lit(False)))
    return df if closed_group is None else df.join(closed_group.select("OU_ID").distinct(), "OU_ID", "left_anti")


def population_access(cells: DataFrame, facilities: DataFrame, edges: DataFrame, district_cell: DataFrame,
                      radius_km: float = 5.0, size: float = 0.5) -> DataFrame:
    """Total and covered population and percent covered per district.

    Distances are great-circle distances. Only facilities inside the country count.
    """
    inside = points_within(facilities.dropna(subset=["LONGITUDE", "LATITUDE"]), edges, ["ADM2_ID"], size)
    # Cells with their population and, once more where a facility is near, as covered: reduced to one row a cell they meet districts once.
    value, none = F.col("value").cast("double"), F.lit(None).cast("double")
    both = cells.select("lon", "lat", value.alias("p"), none.alias("c")).union(
        within_distance(cells, inside, radius_km).select("lon", "lat", none, value))
    per_cell = both.groupBy("lon", "lat").agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    df = per_cell.join(district_cell.select("lon", "lat", "ADM2_ID"), ["lon", "lat"]).groupBy("ADM2_ID").agg(
        F.sum("p").alias("POPULATION"), F.coalesce(F.sum("c"), F.lit(0.0)).alias("COVERED"))
    return df.withColumn("PCT_HEALTH_ACCESS", ratio("COVERED", "POPULATION") * 100)
