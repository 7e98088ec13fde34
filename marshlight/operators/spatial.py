"""Points, polygons and grids as plain tables.

Polygons are edge rows (id columns, ring, seq, x1, y1, x2, y2). For point location the plane is cut into
squares; every square row carries the shapes that touch or cover it, each with only the edges that cross the
square, and whether the square's south-east corner is inside. Crossings between that corner and a point tell
the rest, so a square row stays small however many vertices a polygon has. A point meets exactly one square
row through an equality join, so no pair of all points and all polygons is ever formed, and adaptive
execution can split a square that holds a large part of the points. The index grows with the shapes, not with the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_km

KM_PER_DEGREE = 111.19


def square(c: Column | str, size: float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(size)).cast("bigint")


def polygon_edges(shapes: DataFrame, ids: Sequence[str], geometry: str = "GEOMETRY") -> DataFrame:
    """Edge rows of GeoJSON polygons and multipolygons; a shape without readable rings gives none."""
    text = F.get_json_object(geometry, "$.coordinates")
    kind = F.get_json_object(geometry, "$.type")
    many = F.from_json(text, "array<array<array<array<double>>>>")
    single = F.array(F.from_json(text, "array<array<array<double>>>"))
    rings = F.flatten(F.when(kind == "MultiPolygon", many).when(kind == "Polygon", single))
    ring_rows = shapes.select(*ids, F.posexplode(rings).alias("ring", "points"))
    n = F.size("points")
    # a ring repeats its first point at the end, so n points are n - 1 edges
    sides = F.transform(F.slice("points", F.lit(1), F.greatest(n - 1, F.lit(0))), lambda a, i: F.struct(
        (i + 1).alias("seq"), F.get(a, F.lit(0)).alias("x1"), F.get(a, F.lit(1)).alias("y1"),
        F.get(F.get("points", i + 1), F.lit(0)).alias("x2"), F.get(F.get("points", i + 1), F.lit(1)).alias("y2")))
    return ring_rows.select(*ids, "ring", F.inline(sides))


def usable_edges(edges: DataFrame, shape_id: str) -> DataFrame:
    """Edges of real shapes: coordinates present and at least three edges per shape."""
    ok = edges.dropna(subset=[shape_id, "x1", "y1", "x2", "y2"])
    enough = ok.groupBy(shape_id).agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 3").select(shape_id)
    return ok.join(enough, shape_id, "left_semi")


TOUCH = 1e-9  # share of a square by which edges are taken to reach into the next one, so that rounding loses none


def shape_index(edges: DataFrame, ids: Sequence[str], size: float) -> DataFrame:
    """Rows (bx, by, shapes): the shapes that touch or cover a square, in id order.

    A shape has `odd`, whether the ray to the east from the square's south-east corner crosses an odd number of its edges, and
    the edges that cross the square.
    """
    slack = size * TOUCH
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.select(*ids, "x1", "y1", "x2", "y2").withColumn(
        "by", F.explode(F.sequence(square(low - slack, size), square(high + slack, size)))).withColumn("_y0", F.col("by") * size)
    tilt = (F.col("x2") - F.col("x1")) / F.when(F.col("y2") != F.col("y1"), F.col("y2") - F.col("y1"))

    def at(y: Column) -> Column:
        return F.col("x1") + tilt * (F.least(F.greatest(y, low), high) - F.col("y1"))

    ends = [F.coalesce(at(y), x) for y, x in ((F.col("_y0") - slack, F.col("x1")), (F.col("_y0") + size + slack, F.col("x2")))]
    banded = banded.withColumns({"_w": square(F.least(*ends) - slack, size), "_e": square(F.greatest(*ends) + slack, size)})
    touched = banded.withColumn("bx", F.explode(F.sequence("_w", "_e"))).groupBy(*ids, "by", "bx").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    # Crossings of a band's southern line, each counted in the square whose eastern line is the first that is not west of it.
    crossing = (F.col("x2") - F.col("x1")) * (F.col("_y0") - F.col("y1")) / F.when(F.col("y2") != F.col("y1"), F.col("y2") - F.col("y1")) + F.col("x1")
    guess = (F.ceil(crossing / size) - 1).cast("bigint")
    bucket = F.when(crossing > (guess + 1) * size, guess + 1).when(crossing <= guess * size, guess - 1).otherwise(guess)
    crossed = banded.filter((F.col("y1") > F.col("_y0")) != (F.col("y2") > F.col("_y0"))).groupBy(*ids, "by", bucket.alias("bx")).agg(
        F.count(F.lit(1)).alias("_n"))
    extent = banded.groupBy(*ids, "by").agg(F.min("_w").alias("_w"), F.max("_e").alias("_e"))
    squares = extent.select(*ids, "by", F.explode(F.sequence("_w", "_e")).alias("bx"))
    # The window holds the squares of one shape in one band.
    east = Window.partitionBy(*ids, "by").orderBy(F.desc("bx")).rowsBetween(Window.unboundedPreceding, -1)
    known = squares.join(crossed, [*ids, "by", "bx"], "left").join(touched, [*ids, "by", "bx"], "left").withColumn(
        "odd", F.coalesce(F.sum("_n").over(east), F.lit(0)) % 2 == 1)
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    rows = known.filter(F.col("odd") | F.col("edges").isNotNull()).withColumn("edges", F.coalesce("edges", none))
    return rows.groupBy("bx", "by").agg(F.array_sort(F.collect_list(F.struct(*ids, "odd", "edges"))).alias("shapes"))


def _at(edge: Column, y: Column) -> Column:
    rise = F.when(edge["y2"] != edge["y1"], edge["y2"] - edge["y1"])
    return (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / rise + edge["x1"]


def _on_edge(edge: Column, x: Column, y: Column) -> Column:
    cross = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) - (edge["y2"] - edge["y1"]) * (x - edge["x1"])
    return (
        (cross == 0)
        & x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
        & y.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
    )


def inside(shape: Column, x: Column, y: Column, east: Column, south: Column) -> Column:
    """Even-odd rule from the south-east corner of the point's square: up along its eastern line, then west to the point.

    A point on an edge is outside.
    """
    def across(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < _at(e, y)) & (_at(e, y) <= east)

    def up(e: Column) -> Column:
        height = e["y1"] + (e["y2"] - e["y1"]) * (east - e["x1"]) / F.when(e["x2"] != e["x1"], e["x2"] - e["x1"])
        return ((e["x1"] > east) != (e["x2"] > east)) & ((height > south) != (height > y))

    crossed = F.size(F.filter(shape["edges"], across)) + F.size(F.filter(shape["edges"], up))
    return (shape["odd"] != (crossed % 2 == 1)) & ~F.exists(shape["edges"], lambda e: _on_edge(e, x, y))


def locate(points: DataFrame, edges: DataFrame, ids: Sequence[str], size: float, x: str = "LONGITUDE",
           y: str = "LATITUDE", name: str = "found") -> DataFrame:
    """Each point with `found`: the array of shapes that contain it, in id order (empty when none)."""
    index = shape_index(edges, ids, size)
    keyed = points.withColumns({"bx": square(x, size), "by": square(y, size)})
    px, py = F.col(x), F.col(y)
    east, south = (F.col("bx") + 1) * size, F.col("by") * size
    hits = F.filter(F.col("shapes"), lambda s: inside(s, px, py, east, south))
    found = F.transform(hits, lambda s: F.struct(*[s[i].alias(i) for i in ids]))
    joined = keyed.join(index, ["bx", "by"], "left")
    empty = F.array().cast("array<struct<" + ",".join(f"{i}:string" for i in ids) + ">>")
    typed = F.transform(found, lambda s: F.struct(*[s[i].cast("string").alias(i) for i in ids]))
    return joined.withColumn(name, F.coalesce(typed, empty)).drop("bx", "by", "shapes")


def first_shape(points: DataFrame, edges: DataFrame, ids: Sequence[str], size: float, **kw: str) -> DataFrame:
    """Point to the first shape that contains it; null ids when none does."""
    located = locate(points, edges, ids, size, name="_found", **kw)
    hit = F.get("_found", F.lit(0))
    return located.withColumns({i: hit[i] for i in ids}).drop("_found")


def all_shapes(points: DataFrame, edges: DataFrame, ids: Sequence[str], size: float, **kw: str) -> DataFrame:
    """One row per point and shape that contains it."""
    located = locate(points, edges, ids, size, name="_found", **kw)
    return located.withColumn("_s", F.explode("_found")).select("*", *[F.col("_s")[i].alias(i) for i in ids]).drop(
        "_found", "_s")


def points_within(points: DataFrame, edges: DataFrame, ids: Sequence[str], size: float, **kw: str) -> DataFrame:
    """Points inside any shape."""
    return locate(points, edges, ids, size, name="_found", **kw).filter(F.size("_found") > 0).drop("_found")


def count_per_shape(points: DataFrame, edges: DataFrame, ids: Sequence[str], size: float,
                    name: str = "n_points", **kw: str) -> DataFrame:
    """Number of points per shape, 0 for shapes without any."""
    counts = all_shapes(points, edges, ids, size, **kw).groupBy(*ids).agg(F.count(F.lit(1)).alias(name))
    shapes = edges.select(*[F.col(i).cast("string").alias(i) for i in ids]).distinct()
    return shapes.join(counts, list(ids), "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


FINE = 4  # squares per radius
POLAR = 85.0  # degrees beyond which a square's nearest point is not found by its edges


def reach_index(facilities: DataFrame, radius_km: float, f_lon: str = "LONGITUDE", f_lat: str = "LATITUDE") -> DataFrame:
    """Rows (bx, by, whole, f_lon, f_lat): the squares within reach of a facility.

    A square that lies wholly inside some facility's circle is one row, however many facilities reach it;
    only squares cut by circles and inside none list their facilities for a distance test. A circle that
    crosses the date line has squares on both sides; one near a pole has those of all longitudes.
    """
    size = radius_km / KM_PER_DEGREE * 1.01 / FINE
    places = facilities.select(F.col(f_lon).cast("double").alias("f_lon"), F.col(f_lat).cast("double").alias("f_lat")
                               ).dropna().distinct()
    up = F.lit(size * FINE)
    polar = F.abs(F.col("f_lat")) + up >= POLAR
    across = F.when(polar, 180.0).otherwise(up / F.cos(F.radians(F.least(F.abs(F.col("f_lat")) + up, F.lit(POLAR)))))
    around = places.withColumns({"polar": polar, "across": across, "f_lon": F.explode(F.array(*[F.col("f_lon") + d for d in (-360.0, 0.0, 360.0)]))})
    around = around.withColumns({"w": F.greatest(F.col("f_lon") - F.col("across"), F.lit(-180.0)), "e": F.least(F.col("f_lon") + F.col("across"), F.lit(180.0))})
    low, high = F.greatest(F.col("f_lat") - up, F.lit(-90.0)), F.least(F.col("f_lat") + up, F.lit(90.0))
    squares = around.filter("w <= e").withColumn("bx", F.explode(F.sequence(square("w", size), square("e", size)))).withColumn(
        "by", F.explode(F.sequence(square(low, size), square(high, size))))
    west, south = F.col("bx") * size, F.col("by") * size

    def away(x: Column, y: Column) -> Column:
        return haversine_km(F.col("f_lon"), F.col("f_lat"), x, y)

    corners = F.greatest(*[away(x, y) for x in (west, west + size) for y in (south, south + size)])
    nearest = away(F.least(F.greatest(F.col("f_lon"), west), west + size), F.least(F.greatest(F.col("f_lat"), south), south + size))
    # the margins keep every doubtful square on the exact test
    squares = squares.withColumn("whole", ~F.col("polar") & (corners <= radius_km * 0.999)).filter(
        F.col("polar") | (nearest <= radius_km * 1.01))
    whole = squares.filter("whole").select("bx", "by").distinct()
    cut = squares.filter(~F.col("whole")).join(whole, ["bx", "by"], "left_anti")
    nowhere = F.lit(None).cast("double")
    return whole.select("bx", "by", F.lit(True).alias("whole"), nowhere.alias("f_lon"), nowhere.alias("f_lat")).unionByName(
        cut.select("bx", "by", "whole", "f_lon", "f_lat"))


def within_distance(cells: DataFrame, facilities: DataFrame, radius_km: float, lon: str = "lon",
                    lat: str = "lat", f_lon: str = "LONGITUDE", f_lat: str = "LATITUDE") -> DataFrame:
    """Cells that have a facility within `radius_km` (great-circle distance).

    The facility side is spread over the squares it can reach; a cell looks in its own square only. The
    semi join stops at the first hit, so pairs are never emitted, and around a crowd of facilities most
    squares answer without any distance.
    """
    size = radius_km / KM_PER_DEGREE * 1.01 / FINE
    index = reach_index(facilities, radius_km, f_lon, f_lat).alias("f")
    keyed = cells.withColumns({"bx": square(lon, size), "by": square(lat, size)}).alias("c")
    near = haversine_km(F.col(f"c.{lon}"), F.col(f"c.{lat}"), F.col("f.f_lon"), F.col("f.f_lat")) <= radius_km
    same = (F.col("c.bx") == F.col("f.bx")) & (F.col("c.by") == F.col("f.by"))
    return keyed.join(index, same & (F.col("f.whole") | near), "left_semi").drop("bx", "by")


def grid_index(c: str, origin: float, step: float) -> Column:
    return F.floor((F.col(c) - F.lit(origin)) / F.lit(step)).cast("bigint")


def align_grid(fine: DataFrame, coarse: DataFrame, x0: float, y0: float, dx: float, dy: float,
               value: str, name: str) -> DataFrame:
    """Each fine cell with the value of the coarse cell it falls into (nearest coarse centre)."""
    left = fine.withColumns({"ix": grid_index("lon", x0, dx), "iy": grid_index("lat", y0, dy)})
    right = coarse.select(grid_index("lon", x0, dx).alias("ix"), grid_index("lat", y0, dy).alias("iy"),
                          F.col(value).alias(name))
    return left.join(right, ["ix", "iy"], "left").drop("ix", "iy")


def zonal(cells: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Rounded sum, cell count and mean of the non-missing cells per zone."""
    v = F.col(value)
    return cells.groupBy(*keys).agg(
        F.bround(F.sum(v), 0).cast("bigint").alias("total"),
        F.count(v).alias("cells"),
        F.avg(v).alias("mean"),
    )
