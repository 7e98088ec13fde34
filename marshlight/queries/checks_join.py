"""Join and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..functions.text import hashed_id
from ..operators import joins as J
from ..operators import keys as K
from ..operators import shape as H
from ..operators import spatial as P
from ..plans import access as A
from ..plans import climate as C
from ..plans import formatting as Fm
from ..plans import incidence as I
from ..plans import population as Pop
from .registry import query
from .standins import SIZE, VIEWS


@query("C1_attach_unit_attributes", """
SELECT f.OU_ID, f.PERIOD, f.SUSP, p.OU_NAME, p.ADM1_ID, p.ADM2_ID FROM v_facts f LEFT JOIN v_pyramid p USING (OU_ID)""")
def _(t):
    return J.attach(t.facts.select("OU_ID", "PERIOD", "SUSP"), t.pyramid, ["OU_ID"], ["OU_NAME", "ADM1_ID", "ADM2_ID"])


VIEWS["v_indmap"] = """
SELECT * FROM (VALUES ('SUSP', 'A', NULL), ('SUSP', 'A', 'O'), ('TEST', 'R', NULL), ('CONF', 'R', 'F'),
  ('CONF', 'N', 'O'), ('PRES', 'N', NULL), ('ALLOUT', 'A', NULL), ('ALLOUT', 'N', 'F'), ('NONE', NULL, NULL))
  m(INDICATOR, DX, CO)"""
DEFINITIONS = {"SUSP": ["A", "A.O"], "TEST": ["R"], "CONF": ["R.F", "N.O"], "PRES": ["N"], "ALLOUT": ["A", "N.F"],
               "NONE": []}
VIEWS["v_matched"] = """
SELECT DISTINCT r.*, m.INDICATOR FROM v_raw r JOIN v_indmap m ON r.DX = m.DX AND (m.CO IS NULL OR m.CO = r.CO)"""


def indicator_map(t):
    from ..sources.config import indicator_map as build

    return build(t.spark, DEFINITIONS)


@query("C2_population_by_indicator", """
SELECT a.ADM2_ID, y.YEAR, p.POPULATION, p.POP_UNDER_5 FROM v_admin a CROSS JOIN
  (SELECT unnest(range(1995, 2003)) AS YEAR) y LEFT JOIN v_population p ON p.ADM2_ID = a.ADM2_ID AND p.YEAR = y.YEAR""")
def _(t):
    grid = H.with_values(t.admin.select("ADM2_ID"), "YEAR", list(range(1995, 2003)))
    out = grid.join(t.population.select("ADM2_ID", "YEAR", "POPULATION", "POP_UNDER_5"), ["ADM2_ID", "YEAR"], "left")
    return out.withColumn("YEAR", F.col("YEAR").cast("bigint"))


@query("C3_attach_reporting_rate", """
SELECT d.ADM2_ID, d.YEAR, d.MONTH, d.CONF, r.REPORTING_RATE FROM v_district_month d
LEFT JOIN v_rate r USING (ADM2_ID, YEAR, MONTH)""", "REPORTING_RATE")
def _(t):
    from ..plans.reporting import attach_rate

    return attach_rate(t.district_month.select("ADM2_ID", "YEAR", "MONTH", "CONF"), t.rate)


VIEWS["v_monthly"] = """
SELECT d.*, r.REPORTING_RATE, CASE WHEN TEST != 0 THEN CONF / TEST ELSE 1.0 END AS TPR FROM (
  SELECT ADM1_ID, ADM2_ID, YEAR, MONTH, coalesce(sum(CONF), 0) AS CONF, coalesce(sum(TEST), 0) AS TEST,
    coalesce(sum(SUSP), 0) AS SUSP, coalesce(sum(PRES), 0) AS PRES FROM v_routine GROUP BY ALL) d
LEFT JOIN v_rate r USING (ADM2_ID, YEAR, MONTH)"""
VIEWS["v_n2"] = """
SELECT *, CONF + PRES * TPR AS N1, (CONF + PRES * TPR) / nullif(REPORTING_RATE, 0) AS N2 FROM v_monthly"""
VIEWS["v_n3"] = """
SELECT n.*, coalesce(c.PCT * 100, 100.0) AS CARESEEKING_PCT, N2 / (nullif(coalesce(c.PCT * 100, 100.0), 0) / 100) AS N3
FROM v_n2 n LEFT JOIN v_care c USING (ADM1_ID)"""
N_COLS = "REPORTING_RATE TPR N1 N2"


def monthly(t, method="PRES"):
    return I.monthly_cases(t.routine, t.rate, method)


@query("C4_attach_care_seeking", """
SELECT ADM2_ID, YEAR, MONTH, N2, CARESEEKING_PCT, N3 FROM v_n3""", "N2 CARESEEKING_PCT N3")
def _(t):
    return I.with_care_seeking(monthly(t), I.care_seeking(t.care, "PCT")).select(
        "ADM2_ID", "YEAR", "MONTH", "N2", "CARESEEKING_PCT", "N3")


@query("C4_conflicting_care_seeking", "SELECT ADM1_ID, PCT / 2 * 100 AS CARESEEKING_PCT FROM v_care", "CARESEEKING_PCT")
def _(t):
    """Each region three times: without a value, with its value and with half of it; the lowest known one counts."""
    versions = F.array(F.lit(None).cast("double"), F.col("PCT"), F.col("PCT") / 2)
    return I.care_seeking(t.care.select("ADM1_ID", F.explode(versions).alias("PCT")), "PCT")


@query("C5_attach_population", """
SELECT y.ADM2_ID, y.YEAR, y.CONF, p.POPULATION FROM
  (SELECT ADM2_ID, YEAR, sum(CONF) AS CONF FROM v_monthly GROUP BY ALL) y LEFT JOIN v_population p USING (ADM2_ID, YEAR)""")
def _(t):
    y = monthly(t).groupBy("ADM2_ID", "YEAR").agg(F.sum("CONF").alias("CONF"))
    return J.attach(y, t.population, ["ADM2_ID", "YEAR"], ["POPULATION"])


@query("C6_complete_unit_month_grid", """
SELECT u.ADM2_ID, m.PERIOD, d.CONF FROM (SELECT DISTINCT ADM2_ID FROM v_district_month) u
CROSS JOIN (SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS PERIOD FROM (SELECT unnest(generate_series(
   (SELECT make_date(min(PERIOD) // 100, min(PERIOD) % 100, 1) FROM v_district_month)::TIMESTAMP,
   (SELECT make_date(max(PERIOD) // 100, max(PERIOD) % 100, 1) FROM v_district_month)::TIMESTAMP,
   INTERVAL 1 MONTH)) AS d)) m
LEFT JOIN v_district_month d ON d.ADM2_ID = u.ADM2_ID AND d.PERIOD = m.PERIOD""")
def _(t):
    return H.complete_months(t.district_month, ["ADM2_ID"], ["CONF"])


@query("C7_inner_join_of_summaries", """
SELECT ADM2_ID, YEAR, a.top, b.total FROM
  (SELECT ADM2_ID, YEAR, max(CONF) AS top FROM v_district_month GROUP BY ALL) a
  JOIN (SELECT ADM2_ID, YEAR, sum(POPULATION) AS total FROM v_population GROUP BY ALL) b USING (ADM2_ID, YEAR)""")
def _(t):
    d = t.district_month
    top = d.groupBy("ADM2_ID", "YEAR").agg(F.max("CONF").alias("top"))
    total = t.population.groupBy("ADM2_ID", "YEAR").agg(F.sum("POPULATION").alias("total"))
    return J.join_summaries(top, total, ["ADM2_ID", "YEAR"])


@query("C8_units_by_every_month", """
SELECT p.OU_ID, CAST(year(d) * 100 + month(d) AS INTEGER) AS PERIOD FROM v_pyramid p CROSS JOIN (
  SELECT unnest(generate_series((SELECT make_date(min(PERIOD) // 100, min(PERIOD) % 100, 1) FROM v_routine)::TIMESTAMP,
    (SELECT make_date(max(PERIOD) // 100, max(PERIOD) % 100, 1) FROM v_routine)::TIMESTAMP, INTERVAL 1 MONTH)) AS d)""")
def _(t):
    return H.with_every_month(t.pyramid.select("OU_ID"), t.routine)


_OPEN = """FROM v_pyramid p CROSS JOIN (SELECT DISTINCT PERIOD, make_date(PERIOD // 100, PERIOD % 100, 1) AS d FROM v_routine) m
WHERE {cond}"""


@query("C9a_open_at_month_start", "SELECT p.OU_ID, m.PERIOD " + _OPEN.format(
    cond="OPENING_DATE <= d AND (CLOSED_DATE IS NULL OR CLOSED_DATE > d)"))
def _(t):
    grid = H.with_every_month(t.pyramid.select("OU_ID", "OPENING_DATE", "CLOSED_DATE"), t.routine)
    return grid.filter(J.open_at_month_start("OPENING_DATE", "CLOSED_DATE", "PERIOD")).select("OU_ID", "PERIOD")


@query("C9b_open_in_month", "SELECT p.OU_ID, m.PERIOD " + _OPEN.format(
    cond="OPENING_DATE <= last_day(d) AND (CLOSED_DATE IS NULL OR CLOSED_DATE >= d)"))
def _(t):
    return J.open_in_month(t.pyramid.select("OU_ID", "OPENING_DATE", "CLOSED_DATE"), t.routine).select("OU_ID", "PERIOD")


@query("C9c_open_in_year", """
SELECT y.YEAR, count(p.OU_ID) AS n_open FROM (SELECT DISTINCT YEAR FROM v_routine) y LEFT JOIN v_pyramid p
  ON OPENING_DATE <= make_date(y.YEAR, 12, 31) AND (CLOSED_DATE IS NULL OR CLOSED_DATE >= make_date(y.YEAR, 1, 1))
GROUP BY 1""")
def _(t):
    return J.open_years(t.pyramid, t.routine.select("YEAR").distinct())


@query("C10_members_and_non_members", """
SELECT OU_ID, PERIOD, SUSP, OU_ID IN (SELECT OU_ID FROM v_pyramid WHERE CLOSED_DATE IS NOT NULL) AS in_closed
FROM v_facts WHERE OU_ID NOT IN (SELECT OU_ID FROM v_pyramid WHERE OPENING_DATE IS NULL)""")
def _(t):
    f = t.facts.select("OU_ID", "PERIOD", "SUSP")
    never = t.pyramid.filter("OPENING_DATE is null").select("OU_ID")
    closed = t.pyramid.filter("CLOSED_DATE is not null").select("OU_ID").withColumn("in_closed", F.lit(True))
    return J.attach_flag(f.join(never, "OU_ID", "left_anti"), closed, ["OU_ID"], "in_closed", absent=False)


@query("C10_groups_with_missing", """
SELECT OU_ID, PERIOD, CONF FROM v_routine WHERE OU_ID IN (SELECT OU_ID FROM v_routine WHERE CONF IS NULL)""")
def _(t):
    return K.groups_with_missing(t.routine.select("OU_ID", "PERIOD", "CONF"), "OU_ID", "CONF")


VIEWS["v_inside"] = """
SELECT vec_id, ADM2_ID FROM (
  SELECT c.vec_id, e.ADM2_ID, sum(CASE WHEN (e.y1 > c.lat) != (e.y2 > c.lat)
      AND c.lon < (e.x2 - e.x1) * (c.lat - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 THEN 1 ELSE 0 END) AS crossings,
    max(CASE WHEN (e.x2 - e.x1) * (c.lat - e.y1) - (e.y2 - e.y1) * (c.lon - e.x1) = 0
      AND c.lon BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
      AND c.lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS edge
  FROM v_cells c CROSS JOIN v_edges e GROUP BY 1, 2) WHERE crossings % 2 = 1 AND edge = 0"""


@query("C11_points_in_polygons", "SELECT vec_id, ADM2_ID FROM v_inside")
def _(t):
    return P.all_shapes(t.cells, t.edges, ["ADM2_ID"], SIZE, x="lon", y="lat").select("vec_id", "ADM2_ID")


@query("C11_points_in_country", "SELECT DISTINCT vec_id FROM v_inside")
def _(t):
    return P.points_within(t.cells, t.edges, ["ADM2_ID"], SIZE, x="lon", y="lat").select("vec_id")


@query("C11_E24_first_polygon", """
SELECT c.vec_id, min(i.ADM2_ID) AS ADM2_ID FROM v_cells c LEFT JOIN v_inside i USING (vec_id) GROUP BY 1""")
def _(t):
    return P.first_shape(t.cells, t.edges, ["ADM2_ID"], SIZE, x="lon", y="lat").select("vec_id", "ADM2_ID")


@query("C11_points_per_polygon", """
SELECT e.ADM2_ID, count(i.vec_id) AS n_points FROM (SELECT DISTINCT ADM2_ID FROM v_edges) e
LEFT JOIN v_inside i USING (ADM2_ID) GROUP BY 1""")
def _(t):
    return P.count_per_shape(t.cells, t.edges, ["ADM2_ID"], SIZE, x="lon", y="lat")


_KM = """2 * 6371.0088 * asin(sqrt(least(1.0, sin(radians(b.lat - a.lat) / 2) ** 2
  + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ** 2)))"""
VIEWS["v_covered"] = f"""
SELECT a.* FROM v_cells a WHERE EXISTS (SELECT 1 FROM v_cells b WHERE b.label = 3 AND {_KM} <= 3.0)"""


@query("C12_cells_near_facilities", "SELECT vec_id FROM v_covered")
def _(t):
    sites = t.cells.filter("label = 3").select(F.col("lon").alias("LONGITUDE"), F.col("lat").alias("LATITUDE"))
    return P.within_distance(t.cells, sites, 3.0).select("vec_id")


VIEWS["v_cell_district"] = """
SELECT DISTINCT c.lon, c.lat, i.ADM2_ID FROM v_cells c JOIN v_inside i USING (vec_id)"""


@query("C13_cell_to_district", "SELECT * FROM v_cell_district")
def _(t):
    return C.district_cells(t.cells, t.edges, SIZE)


VIEWS["v_coarse"] = """
SELECT floor((lon + 1.0) / 0.1) AS ix, floor((lat + 1.0) / 0.1) AS iy, max(value) AS metric FROM v_cells GROUP BY 1, 2"""


def coarse(t):
    """A coarse grid derived from the cells: one row per 0.1 degree square, at its centre."""
    ix, iy = P.grid_index("lon", -1.0, 0.1), P.grid_index("lat", -1.0, 0.1)
    g = t.cells.groupBy(ix.alias("ix"), iy.alias("iy")).agg(F.max("value").alias("metric"))
    return g.select((F.col("ix") * 0.1 - 0.95).alias("lon"), (F.col("iy") * 0.1 - 0.95).alias("lat"), "metric")


@query("C14_align_grids", """
SELECT c.vec_id, c.value, g.metric FROM v_cells c LEFT JOIN v_coarse g
  ON g.ix = floor((c.lon + 1.0) / 0.1) AND g.iy = floor((c.lat + 1.0) / 0.1)""")
def _(t):
    return P.align_grid(t.cells, coarse(t), -1.0, -1.0, 0.1, 0.1, "metric", "metric").select("vec_id", "value", "metric")


@query("C15_match_indicator_definitions", "SELECT OU, PE, DX, CO, INDICATOR FROM v_matched")
def _(t):
    return J.mapping_join(t.raw, indicator_map(t)).select("OU", "PE", "DX", "CO", "INDICATOR")


VIEWS["v_update"] = """
SELECT a.ADM2_ID, a.old, b.new FROM (SELECT ADM2_ID, sum(SUSP) AS old FROM v_routine GROUP BY 1) a
LEFT JOIN (SELECT ADM2_ID, nullif(sum(CONF) FILTER (WHERE YEAR = 1996 AND ADM1_ID <> 'R2'), 0) / 3 AS new FROM v_routine
  GROUP BY 1) b USING (ADM2_ID)"""


def _update_sides(t):
    old = t.routine.groupBy("ADM2_ID").agg(F.sum("SUSP").alias("v"))
    new = t.routine.groupBy("ADM2_ID").agg(
        (F.nullif(F.sum(F.when((F.col("YEAR") == 1996) & (F.col("ADM1_ID") != "R2"), F.col("CONF"))), F.lit(0)) / 3).alias("v"))
    return old, new


@query("C16_update_keep_old", "SELECT ADM2_ID, coalesce(new, old) AS v FROM v_update", "v")
def _(t):
    return J.update_columns(*_update_sides(t), ["ADM2_ID"], ["v"])


@query("C17_update_overwrite", "SELECT ADM2_ID, round_even(new, 2) AS v FROM v_update")
def _(t):
    return J.update_columns(*_update_sides(t), ["ADM2_ID"], ["v"], keep_old=False, rounding=2)


@query("C18_user_layer", """
SELECT a.ADM1_NAME, a.ADM1_ID, a.ADM2_NAME, a.ADM2_ID, p.POPULATION, CAST(NULL AS DOUBLE) AS CONF FROM v_admin a
LEFT JOIN (SELECT ADM2_ID, max(POPULATION) AS POPULATION FROM v_population GROUP BY 1) p USING (ADM2_ID)""")
def _(t):
    from ..plans.assemble import add_user_layer, empty_results

    layer = t.population.groupBy("ADM2_ID").agg(F.max("POPULATION").alias("POPULATION")).withColumns(
        {"ADM2_NAME": F.lit("other"), "UNKNOWN": F.lit(1)})
    return add_user_layer(empty_results(t.admin, ["POPULATION", "CONF"]), layer)


@query("C19_flag_back_to_larger_table", """
SELECT l.OU_ID, l.PERIOD, l.INDICATOR, coalesce(s.f, true) AS f FROM v_long l
LEFT JOIN (SELECT OU_ID, PERIOD, INDICATOR, VALUE > 100 AS f FROM v_long WHERE VALUE > 50) s
  USING (OU_ID, PERIOD, INDICATOR)""")
def _(t):
    some = t.long.filter("VALUE > 50").withColumn("f", F.col("VALUE") > 100)
    return J.attach_flag(t.long.select("OU_ID", "PERIOD", "INDICATOR"), some, ["OU_ID", "PERIOD", "INDICATOR"], "f", True)


@query("C20_remap_units", """
SELECT p.OU_ID, CASE WHEN p.OU_ID = 'F7' THEN 'PATCHED' ELSE m.NEW_NAME END AS NEW_NAME,
  substr(sha256(CASE WHEN p.OU_ID = 'F7' THEN 'PATCHED' ELSE m.NEW_NAME END), 1, 11) AS NEW_ID
FROM v_pyramid p JOIN (SELECT ADM2_ID, min(ADM2_NAME || '_' || YEAR) AS NEW_NAME FROM v_population GROUP BY 1) m
USING (ADM2_ID)""")
def _(t):
    mapping = t.population.select("ADM2_ID", F.concat_ws("_", "ADM2_NAME", "YEAR").alias("NEW_NAME"))
    out = J.remap_units(t.pyramid.select("OU_ID", "ADM2_ID"), mapping, ["ADM2_ID"], ["NEW_NAME"],
                        {"F7": {"NEW_NAME": "PATCHED"}})
    return out.select("OU_ID", "NEW_NAME", hashed_id("NEW_NAME").alias("NEW_ID"))


VIEWS["v_units"] = """
SELECT 'U' || vec_id AS id, 'UNIT ' || vec_id AS name, CAST(CASE WHEN label = 1 THEN 3 WHEN label = 2 THEN 4
    WHEN label = 3 THEN 5 ELSE 6 END AS INTEGER) AS level,
  CASE WHEN label = 1 THEN 'U' || vec_id WHEN label IN (2, 3) THEN 'U' || (vec_id // 50 * 50) ELSE 'DX' END AS level_3_id,
  CASE WHEN label = 1 THEN 'UNIT ' || vec_id WHEN label IN (2, 3) THEN 'UNIT ' || (vec_id // 50 * 50) ELSE 'DX NAME' END
    AS level_3_name,
  CASE WHEN label = 2 THEN 'U' || vec_id END AS level_4_id, CASE WHEN label = 2 THEN 'UNIT ' || vec_id END AS level_4_name,
  CASE WHEN label = 3 THEN 'U' || vec_id END AS level_5_id, CASE WHEN label = 3 THEN 'UNIT ' || vec_id END AS level_5_name,
  CASE WHEN label NOT IN (1, 2, 3) THEN 'U' || vec_id END AS level_6_id,
  CASE WHEN label NOT IN (1, 2, 3) THEN 'UNIT ' || vec_id END AS level_6_name, CASE WHEN vec_id % 7 <> 3 THEN lon END AS lon, lat, vec_id
FROM v_cells"""


def units(t):
    i, label = F.col("vec_id"), F.col("label")
    own_id, own_name = F.concat(F.lit("U"), i), F.concat(F.lit("UNIT "), i)
    up = F.floor(i / 50) * 50
    lower = label.isin(2, 3)
    return t.cells.select(
        own_id.alias("id"), own_name.alias("name"),
        F.when(label == 1, 3).when(label == 2, 4).when(label == 3, 5).otherwise(6).alias("level"),
        F.when(label == 1, own_id).when(lower, F.concat(F.lit("U"), up)).otherwise("DX").alias("level_3_id"),
        F.when(label == 1, own_name).when(lower, F.concat(F.lit("UNIT "), up)).otherwise("DX NAME").alias("level_3_name"),
        F.when(label == 2, own_id).alias("level_4_id"), F.when(label == 2, own_name).alias("level_4_name"),
        F.when(label == 3, own_id).alias("level_5_id"), F.when(label == 3, own_name).alias("level_5_name"),
        F.when(~label.isin(1, 2, 3), own_id).alias("level_6_id"),
        F.when(~label.isin(1, 2, 3), own_name).alias("level_6_name"), F.when(i % 7 != 3, F.col("lon")).alias("lon"), "lat")


VIEWS["v_moved"] = """
SELECT u.*, d.ADM2_ID AS new_id, d.ADM2_NAME AS new_name FROM v_units u LEFT JOIN (
  SELECT vec_id, min(ADM2_ID) AS ADM2_ID, 'DS ' || min(ADM2_ID) AS ADM2_NAME FROM v_inside GROUP BY 1) d USING (vec_id)
WHERE level = 3"""


@query("C21_K6_relevel_units", """
SELECT id, name, CAST(6 AS INTEGER) AS level, CASE WHEN lon IS NULL THEN level_3_id ELSE new_id END AS level_3_id,
  CASE WHEN lon IS NULL THEN level_3_name ELSE new_name END AS level_3_name, NULL AS level_4_id, NULL AS level_4_name, NULL AS level_5_id,
  NULL AS level_5_name, CASE WHEN lon IS NOT NULL THEN id END AS level_6_id,
  CASE WHEN lon IS NOT NULL THEN name END AS level_6_name FROM v_moved
UNION ALL SELECT u.id, u.name, 6, CASE WHEN m.id IS NULL THEN u.level_3_id ELSE m.new_id END,
  CASE WHEN m.id IS NULL THEN u.level_3_name ELSE m.new_name END, NULL, NULL, NULL,
  NULL, u.id, u.name FROM v_units u LEFT JOIN v_moved m ON m.id = u.level_3_id AND m.lon IS NOT NULL
WHERE u.level IN (4, 5)
UNION ALL SELECT id, name, level, level_3_id, level_3_name, level_4_id, level_4_name, level_5_id, level_5_name,
  level_6_id, level_6_name FROM v_units WHERE level = 6""")
def _(t):
    u = units(t)
    edges = t.edges.select(F.col("ADM2_ID").alias("district_id"), F.col("ADM2_NAME").alias("district_name"), "seq",
                           "x1", "y1", "x2", "y2")
    return Fm.relevel(u, u.filter("level < 6"), edges, size=SIZE).drop("lon", "lat")


@query("C22_attach_names", """
SELECT d.ADM2_ID, d.PERIOD, d.CONF, a.ADM2_NAME FROM v_district_month d LEFT JOIN v_admin a USING (ADM2_ID)""")
def _(t):
    return J.attach(t.district_month.select("ADM2_ID", "PERIOD", "CONF"), t.pyramid, ["ADM2_ID"], ["ADM2_NAME"])


@query("C23_match_regions_by_name", """
SELECT a.ADM2_ID, a.ADM1_NAME, s.n FROM v_admin a LEFT JOIN (
  SELECT CASE WHEN V024 <> 2 THEN ADM1_NAME END AS ADM1_NAME, count(*) AS n FROM v_survey GROUP BY 1) s USING (ADM1_NAME)""")
def _(t):
    from ..functions.text import normalise_name

    known = F.when(F.col("V024") != 2, normalise_name("ADM1_NAME"))
    s = t.survey.groupBy(known.alias("ADM1_NAME")).agg(
        F.count(F.lit(1)).alias("n"))
    return t.admin.select("ADM2_ID", "ADM1_NAME").join(s, "ADM1_NAME", "left")


VIEWS["v_weighted"] = """
SELECT i.ADM2_ID, sum(i.value * g.metric) AS WEIGHTED_SUM, round_even(sum(i.value), 0) AS POPULATION
FROM (SELECT d.ADM2_ID, c.lon, c.lat, c.value FROM v_cell_district d JOIN v_cells c USING (lon, lat)) i
LEFT JOIN v_coarse g ON g.ix = floor((i.lon + 1.0) / 0.1) AND g.iy = floor((i.lat + 1.0) / 0.1) GROUP BY 1"""


@query("C24_D18_population_weighted_metric", """
SELECT *, WEIGHTED_SUM / nullif(POPULATION, 0) AS POPULATION_WEIGHTED FROM v_weighted""",
       "WEIGHTED_SUM POPULATION_WEIGHTED")
def _(t):
    aligned = P.align_grid(t.cells, coarse(t), -1.0, -1.0, 0.1, 0.1, "metric", "metric")
    return C.weighted_metric(aligned, t.district_cells, "value", "metric")


@query("C25_outlier_flag_back_to_routine", """
SELECT r.OU_ID, r.PERIOD, r.SUSP, coalesce(s.f, false) AS f FROM v_routine r
LEFT JOIN (SELECT OU_ID, PERIOD, true AS f FROM v_long WHERE INDICATOR = 'SUSP' AND VALUE > 150) s USING (OU_ID, PERIOD)""")
def _(t):
    high = t.long.filter("INDICATOR = 'SUSP' and VALUE > 150").select("OU_ID", "PERIOD", F.lit(True).alias("f"))
    return J.attach_flag(t.routine.select("OU_ID", "PERIOD", "SUSP"), high, ["OU_ID", "PERIOD"], "f", False)


@query("C26_compare_population_sources", """
SELECT ADM2_ID, POP_A, POP_B, POP_B - POP_A AS DIFF, POP_B / nullif(POP_A, 0) AS RATIO,
  (POP_B - POP_A) / nullif(POP_A, 0) AS REL_DIFF
FROM (SELECT ADM2_ID, POPULATION AS POP_A FROM v_population WHERE YEAR = (SELECT max(YEAR) FROM v_population)) a
LEFT JOIN (SELECT ADM2_ID, sum(SUSP) AS POP_B FROM v_routine WHERE YEAR = (SELECT max(YEAR) FROM v_routine) GROUP BY 1) b
USING (ADM2_ID)""", "RATIO REL_DIFF")
def _(t):
    other = t.routine.groupBy("ADM2_ID", "YEAR").agg(F.sum("SUSP").alias("POPULATION"))
    return Pop.compare_sources(t.population, other, 2030)


# --- sets -------------------------------------------------------------------------------------------


@query("G1_union_of_frames", """
SELECT ADM2_ID, YEAR, 'population' AS what, POPULATION AS v FROM v_population
UNION ALL SELECT ADM2_ID, YEAR, 'cases', CONF FROM v_district_month""")
def _(t):
    a = t.population.select("ADM2_ID", "YEAR", F.lit("population").alias("what"), F.col("POPULATION").alias("v"))
    b = t.district_month.select(F.col("CONF").alias("v"), "YEAR", "ADM2_ID", F.lit("cases").alias("what"))
    return H.union_all([a, b])


@query("G2_G3_only_in_left", """
SELECT OU_ID, PERIOD FROM v_routine EXCEPT SELECT OU, CAST(PE AS INTEGER) + 1 FROM v_raw""")
def _(t):
    # facility months whose month before has no raw record
    raw = t.raw.select(F.col("OU").alias("U"), (F.col("PE").cast("int") + 1).alias("P"))
    return K.only_in_left(t.routine, raw, ["OU_ID", "PERIOD"], ["U", "P"])


@query("G4_same_sets", """
SELECT (SELECT count(*) FROM (SELECT OU_ID FROM v_pyramid EXCEPT SELECT OU_ID FROM v_facts)) AS only_left,
  (SELECT count(*) FROM (SELECT OU_ID FROM v_facts EXCEPT SELECT OU_ID FROM v_pyramid)) AS only_right,
  (SELECT count(*) FROM (SELECT OU_ID FROM v_pyramid EXCEPT SELECT OU_ID FROM v_facts)) = 0
  AND (SELECT count(*) FROM (SELECT OU_ID FROM v_facts EXCEPT SELECT OU_ID FROM v_pyramid)) = 0 AS matches""")
def _(t):
    return K.sets_match(t.pyramid, t.facts, ["OU_ID"], ["OU_ID"])


@query("G6_first_by_id", """
SELECT l_suppkey AS id, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1""")
def _(t):
    li = t.raw_table("lineitem").select(F.col("l_suppkey").alias("id"), "l_orderkey")
    return K.first_per_key(li, ["id"], ["l_orderkey"])


# --- access -----------------------------------------------------------------------------------------


@query("D19_K20_population_access", f"""
SELECT z.ADM2_ID, sum(z.value) AS POPULATION, sum(CASE WHEN near THEN z.value ELSE 0 END) AS COVERED,
  sum(CASE WHEN near THEN z.value ELSE 0 END) / nullif(sum(z.value), 0) * 100 AS PCT_HEALTH_ACCESS
FROM (SELECT d.ADM2_ID, a.value, EXISTS (SELECT 1 FROM v_cells b WHERE b.label = 3
        AND b.vec_id IN (SELECT vec_id FROM v_inside) AND {_KM} <= 5.0) AS near
      FROM v_cells a JOIN v_cell_district d USING (lon, lat)) z GROUP BY 1""", "POPULATION COVERED PCT_HEALTH_ACCESS")
def _(t):
    sites = t.cells.filter("label = 3").select(F.col("lon").alias("LONGITUDE"), F.col("lat").alias("LATITUDE"))
    return A.population_access(t.cells, sites, t.edges, t.district_cells, 5.0, SIZE)


@query("B8_active_facilities", """
SELECT OU_ID, OU_NAME FROM v_pyramid WHERE CLOSED_DATE IS NULL AND NOT regexp_matches(OU_NAME, '(?i)cloture|ferme')
  AND OU_ID NOT IN (SELECT 'F' || s_suppkey FROM supplier WHERE s_acctbal < 0)""")
def _(t):
    closed = t.raw_table("supplier").filter("s_acctbal < 0").select(F.concat(F.lit("F"), "s_suppkey").alias("OU_ID"))
    return A.active_facilities(t.pyramid, closed).select("OU_ID", "OU_NAME")


