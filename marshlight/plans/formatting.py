"""Raw extracts to the standard tables: routine, population, pyramid, reporting, shapes, re-levelled units."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import on_earth, parse_point, point_text, position_candidates
from ..functions.nulls import to_num, truncate_int
from ..functions.periods import month_of, year_of
from ..functions.text import clean_columns, normalise_name_columns
from ..operators.joins import attach, mapping_join
from ..operators.keys import first_per_key
from ..operators.shape import pad_columns, require, wide_form, with_values
from ..operators.spatial import first_shape, locate, usable_edges


def admin_columns(levels: Mapping[str, int]) -> dict[str, str]:
    """Configured levels, e.g. {"ADM1": 2, "ADM2": 3, "OU": 6}, to {LEVEL_2_ID: ADM1_ID, ...}."""
    return {f"LEVEL_{n}_{part}": f"{role}_{part}" for role, n in levels.items() for part in ("ID", "NAME")}


def admin_table(pyramid: DataFrame, levels: Mapping[str, int], keep: Sequence[str] = ()) -> DataFrame:
    """Distinct units under their standard column names."""
    renames = admin_columns(levels)
    require(pyramid, list(renames), "pyramid")
    return pyramid.select(*[F.col(c).alias(n) for c, n in renames.items()], *keep).distinct()


def units_at_level(units: DataFrame, level: int, prefix: str | None = None) -> DataFrame:
    out = units.filter(F.col("level") == level)
    return out if prefix is None else out.filter(F.col("name").startswith(prefix))


def build_indicators(raw: DataFrame, mapping: DataFrame, unit: str = "OU", period: str = "PE") -> DataFrame:
    """Long indicator values per unit and month: the sum of the matched data elements, null only if all are.

    The raw rows are summed per (unit, month, indicator) with map-side combine straight after the match.
    """
    facts = raw.select(unit, period, "DX", "CO", to_num("VALUE").alias("VALUE"))
    matched = mapping_join(facts, mapping)
    return matched.groupBy(unit, period, "INDICATOR").agg(F.sum("VALUE").alias("VALUE"))


def format_routine(raw: DataFrame, mapping: DataFrame, indicators: Sequence[str],
                   pyramid: DataFrame) -> DataFrame:
    """Wide routine table. Every facility and month of the raw extract keeps its row.

    `indicators` also lists those with an empty definition; they become null columns. Matching, summing and
    widening are one aggregation: raw rows that match nothing stay in it with no indicator, so their
    facility and month appear without a second pass over the extract.
    """
    facts = raw.select("OU", "PE", "DX", "CO", to_num("VALUE").alias("VALUE"))
    wide = wide_form(mapping_join(facts, mapping, how="left"), ["OU", "PE"], indicators, agg="sum")
    table = wide.select(F.col("PE").cast("int").alias("PERIOD"), year_of("PE").alias("YEAR"),
                        month_of("PE").alias("MONTH"), F.col("OU").alias("OU_ID"), *indicators)
    return attach(table, normalise_name_columns(pyramid), ["OU_ID"])


def format_population(raw: DataFrame, mapping: DataFrame, indicators: Sequence[str], admin: DataFrame,
                      years: Sequence[int], unit: str = "ADM2_ID") -> DataFrame:
    """District population by year: every district and year has a row, decimals are cut off, sums are 0-based."""
    whole = F.coalesce(truncate_int("VALUE"), F.lit(0)).cast("double")
    matched = mapping_join(raw, mapping).withColumn("VALUE", whole)
    wide = wide_form(matched, ["OU", "PE"], indicators, agg="sum").select(
        F.col("OU").alias(unit), F.col("PE").cast("int").alias("YEAR"), *indicators)
    grid = with_values(normalise_name_columns(admin), "YEAR", list(years))
    return grid.join(wide, [unit, "YEAR"], "left")


def format_reporting(raw: DataFrame, metrics: Mapping[str, str], pyramid: DataFrame) -> DataFrame:
    """Dataset reports `PRODUCT.METRIC` with names, numbers and standard unit columns."""
    df = clean_columns(raw)
    parts = F.split("DX", r"\.")
    names = F.create_map(*[F.lit(x) for kv in metrics.items() for x in kv]) if metrics else None
    product = F.get(parts, F.lit(0))
    df = df.select(
        F.col("PE").cast("int").alias("PERIOD"), year_of("PE").alias("YEAR"), month_of("PE").alias("MONTH"),
        F.col("OU").alias("OU_ID"), product.alias("PRODUCT_UID"),
        (F.try_element_at(names, product) if names is not None else F.lit(None).cast("string")).alias("PRODUCT_NAME"),
        F.get(parts, F.lit(1)).alias("PRODUCT_METRIC"), to_num("VALUE").alias("VALUE"),
    )
    return attach(df, normalise_name_columns(pyramid), ["OU_ID"])


def repair_positions(units: DataFrame, edges: DataFrame, unit: str = "OU_ID", shape_id: str = "ADM2_ID",
                     size: float = 0.5, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """LONGITUDE/LATITUDE of `units` moved to the first plausible candidate inside the country.

    With `box` = (lon min, lon max, lat min, lat max) the country is a rectangle and no shapes are needed.
    The first candidate is the position as it is; only units that are not inside with it are spread into the others.
    """
    has = F.col("LONGITUDE").isNotNull() & F.col("LATITUDE").isNotNull()

    def with_hit(points: DataFrame) -> DataFrame:
        if box is not None:
            hit = F.col("lon").between(box[0], box[1]) & F.col("lat").between(box[2], box[3])
            return points.withColumn("hit", F.coalesce(hit & on_earth("lon", "lat"), F.lit(False)))
        found = locate(points, usable_edges(edges, shape_id), [shape_id], size, x="lon", y="lat")
        return found.withColumn("hit", (F.size("found") > 0) & F.coalesce(on_earth("lon", "lat"), F.lit(False)))

    candidates = position_candidates("LONGITUDE", "LATITUDE")
    fields = ["pos", F.col("c.method").alias("method"), F.col("c.lon").alias("lon"), F.col("c.lat").alias("lat")]
    first = with_hit(units.filter(has).select(unit, "LONGITUDE", "LATITUDE", F.lit(0).alias("pos"), candidates[0].alias("c"))
                     .select(unit, "LONGITUDE", "LATITUDE", *fields))
    others = first.filter(~F.col("hit")).select(unit, F.posexplode(F.slice(candidates, 2, 100)).alias("pos", "c"))
    others = with_hit(others.select(unit, *fields).withColumn("pos", F.col("pos") + 1).filter(on_earth("lon", "lat")))
    keep = [unit, "pos", "method", "lon", "lat"]
    inside = first.filter("hit").select(*keep).unionByName(others.filter("hit").select(*keep))
    best = inside.groupBy(unit).agg(F.min_by(F.struct("method", "lon", "lat"), "pos").alias("_best"))
    out = units.join(best, unit, "left")
    method = (F.when(~has, F.lit("MISSING_COORDINATES"))
              .otherwise(F.coalesce("_best.method", F.lit("INVALID_NO_MATCH"))))
    return out.withColumns({
        "LONGITUDE_ORIGINAL": F.col("LONGITUDE"), "LATITUDE_ORIGINAL": F.col("LATITUDE"),
        "LONGITUDE": F.col("_best.lon"), "LATITUDE": F.col("_best.lat"),
        "COORD_FIX_METHOD": method, "COORD_IS_VALID": F.col("_best").isNotNull(),
    }).drop("_best")


def invalid_positions(repaired: DataFrame) -> DataFrame:
    """Units that have coordinates but none that could be placed."""
    return repaired.filter(
        ~F.col("COORD_IS_VALID") & F.col("LONGITUDE_ORIGINAL").isNotNull() & F.col("LATITUDE_ORIGINAL").isNotNull()
    ).withColumn("REASON", F.col("COORD_FIX_METHOD"))


def repair_summary(repaired: DataFrame) -> DataFrame:
    return repaired.groupBy("COORD_FIX_METHOD").agg(F.count(F.lit(1)).alias("n"))


def format_pyramid(raw: DataFrame, edges: DataFrame, unit: str, size: float = 0.5) -> DataFrame:
    """Names cleaned, coordinates read from point text and repaired."""
    point = parse_point("GEOMETRY")
    df = normalise_name_columns(raw).withColumns({"LONGITUDE": point["lon"], "LATITUDE": point["lat"]})
    return repair_positions(df.drop("GEOMETRY"), edges, unit, size=size)


def format_shapes(shapes: DataFrame, levels: Mapping[str, int]) -> DataFrame:
    """Shape attributes under standard names, names cleaned."""
    table = normalise_name_columns(admin_table(shapes, levels))
    return pad_columns(table, ["ADM1_NAME", "ADM1_ID", "ADM2_NAME", "ADM2_ID"], {})


LEVELS = range(1, 7)


def level_cols(n: int) -> list[str]:
    return [f"level_{n}_id", f"level_{n}_name"]


def relevel(units: DataFrame, priority: DataFrame, edges: DataFrame, district_level: int = 3, leaf: int = 6,
            size: float = 0.5, prefix: str = "DS") -> DataFrame:
    """Move facilities that sit at district level or just below to the leaf level.

    units(id, name, level, level_n_id, level_n_name, lon, lat); `priority(id)` lists the facilities that
    are misplaced. Those at district level are placed in the district shape that contains them (first
    match, district names start with `prefix`); a point that none contains becomes a leaf without a
    district, a unit without a point keeps its places. Others whose district-level parent was itself moved
    take that parent's new district, or lack of one. Whole move = two joins on the unit id, no loop over units.
    """
    chosen = units.join(priority.select("id").distinct(), "id", "left_semi")
    d_id, d_name = level_cols(district_level)
    leaf_id, leaf_name = level_cols(leaf)
    at_district = chosen.filter(F.col("level") == district_level)
    named = edges.filter(F.col("district_name").startswith(prefix))
    placed = first_shape(at_district, named, ["district_id", "district_name"], size, x="lon", y="lat")
    at_point = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    moved = placed.withColumns({
        leaf_id: F.when(at_point, F.col("id")),
        leaf_name: F.when(at_point, F.col("name")),
        d_id: F.when(at_point, F.col("district_id")).otherwise(F.col(d_id)),
        d_name: F.when(at_point, F.col("district_name")).otherwise(F.col(d_name)),
        "level": F.lit(leaf),
    }).select(*units.columns)
    parents = moved.filter(F.col(leaf_id).isNotNull()).select(
        F.col(leaf_id).alias(d_id), F.col(d_id).alias("_new_id"), F.col(d_name).alias("_new_name"), F.lit(True).alias("_moved"))
    below = chosen.filter((F.col("level") > district_level) & (F.col("level") < leaf))
    shifted = below.join(parents, d_id, "left")
    own_id = F.coalesce(*[F.when(F.col("level") == n, F.col(f"level_{n}_id"))
                          for n in range(district_level + 1, leaf)])
    own_name = F.coalesce(*[F.when(F.col("level") == n, F.col(f"level_{n}_name"))
                            for n in range(district_level + 1, leaf)])
    changes = {leaf_id: own_id, leaf_name: own_name, d_id: F.when(F.col("_moved"), F.col("_new_id")).otherwise(F.col(d_id)),
               d_name: F.when(F.col("_moved"), F.col("_new_name")).otherwise(F.col(d_name)), "level": F.lit(leaf)}
    for n in range(district_level + 1, leaf):
        for c in level_cols(n):
            changes[c] = F.when(F.col("level") != n, F.col(c))
    shifted = shifted.withColumns(changes).select(*units.columns)
    leaves = chosen.filter(F.col("level") == leaf)
    ranked = (moved.withColumn("_o", F.lit(1)).unionByName(shifted.withColumn("_o", F.lit(2)))
              .unionByName(leaves.withColumn("_o", F.lit(3))))
    new_leaves = first_per_key(ranked, ["id"], ["_o"]).drop("_o")
    stays = units.join(priority.select("id").distinct(), "id", "left_anti")
    stays = stays.filter((F.col("level") != district_level) | F.col("name").contains(prefix))
    return stays.unionByName(new_leaves)


def point_column(df: DataFrame, lon: str, lat: str, name: str = "geometry") -> DataFrame:
    return df.withColumn(name, point_text(lon, lat))
