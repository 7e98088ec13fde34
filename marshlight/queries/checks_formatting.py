"""Scalar functions and the formatting jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import binning as B
from ..functions import geo as G
from ..functions import nulls as N
from ..functions import periods as Pd
from ..functions import text as X
from ..plans import formatting as Fm
from ..plans import incidence as I
from ..plans import population as Pop
from .checks_join import indicator_map, monthly
from .registry import query
from .standins import SIZE, VIEWS


@query("H1_normalise_names", """
SELECT doc_id, trim(regexp_replace(upper(replace(replace(replace(replace(replace(translate(text,
  'ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ', 'AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy'),
  'Æ', 'AE'), 'æ', 'ae'), 'Œ', 'OE'), 'œ', 'oe'), 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g')) AS name FROM documents""")
def _(t):
    return t.raw_table("documents").select("doc_id", X.normalise_name("text").alias("name"))


@query("H2_year_and_month", """
SELECT OU, PE, CAST(substr(PE, 1, 4) AS INTEGER) AS y, CAST(substr(PE, 5, 2) AS INTEGER) AS m FROM v_raw""")
def _(t):
    return t.raw.select("OU", "PE", Pd.year_of("PE").alias("y"), Pd.month_of("PE").alias("m"))


@query("H3_month_dates", """
SELECT OU_ID, PERIOD, strftime(d, '%Y-%m-%d') AS first, strftime(last_day(d), '%Y-%m-%d') AS last,
  CAST(YEAR * 12 + MONTH - 1 AS INTEGER) AS idx FROM (SELECT *, make_date(YEAR, MONTH, 1) AS d FROM v_routine)""")
def _(t):
    return t.routine.select("OU_ID", "PERIOD", F.date_format(Pd.month_start("PERIOD"), "yyyy-MM-dd").alias("first"),
                            F.date_format(Pd.month_end("PERIOD"), "yyyy-MM-dd").alias("last"),
                            Pd.month_index("PERIOD").alias("idx"))


@query("H4_week_keys", """
SELECT o_orderkey, strftime(o_orderdate, '%GW%V') AS week, strftime(o_orderdate, '%Y%m') AS month,
  year(mid) || 'ThuW' || lpad(CAST((dayofyear(mid) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS epi_week
FROM (SELECT *, CAST(o_orderdate AS DATE) - CAST((isodow(o_orderdate) + 3) % 7 AS INTEGER) + 3 AS mid FROM orders)""")
def _(t):
    return t.raw_table("orders").select("o_orderkey", Pd.iso_week("o_orderdate").alias("week"),
                                        Pd.month_key("o_orderdate").alias("month"), Pd.epi_week("o_orderdate").alias("epi_week"))


@query("H6_point_text", """
SELECT vec_id, printf('{"type": "Point", "coordinates": [%f, %f]}', lon, lat) AS geometry FROM v_cells""")
def _(t):
    return Fm.point_column(t.cells.select("vec_id", "lon", "lat"), "lon", "lat").drop("lon", "lat")


@query("H10_test_positivity", "SELECT ADM2_ID, YEAR, MONTH, TPR FROM v_monthly", "TPR")
def _(t):
    return monthly(t).select("ADM2_ID", "YEAR", "MONTH", "TPR")


@query("H11_H12_susp_minus_test", """
SELECT ADM2_ID, YEAR, MONTH, least(TEST, SUSP) AS TEST, CONF + (SUSP - least(TEST, SUSP)) *
  (CASE WHEN least(TEST, SUSP) != 0 THEN CONF / least(TEST, SUSP) ELSE 1.0 END) AS N1 FROM v_monthly""", "N1")
def _(t):
    return monthly(t, "SUSP-TEST").select("ADM2_ID", "YEAR", "MONTH", "TEST", "N1")


@query("H12_H13_adjusted_cases", "SELECT ADM2_ID, YEAR, MONTH, N1, N2 FROM v_n2", "N1 N2")
def _(t):
    return monthly(t).select("ADM2_ID", "YEAR", "MONTH", "N1", "N2")


@query("H14_older_sector_shares", """
SELECT ADM2_ID, YEAR, MONTH, N2 + N2 * (1 - PCT) / 2 / nullif(PCT, 0) + N2 * (1 - PCT) / 2 / nullif(PCT, 0) AS N3
FROM v_n2 JOIN v_care USING (ADM1_ID)""", "N3")
def _(t):
    half = (1 - F.col("PCT")) / 2
    shares = t.care.select("ADM1_ID", F.col("PCT").alias("PCT_PUBLIC_CARE"), half.alias("PCT_PRIVATE_CARE"), half.alias("PCT_NO_CARE"))
    return I.with_sector_shares(monthly(t), shares).select("ADM2_ID", "YEAR", "MONTH", "N3")


@query("H14_older_plain_share", """
SELECT ADM2_ID, YEAR, MONTH, N2 / nullif(PCT, 0) AS N3 FROM v_n2 JOIN v_care USING (ADM1_ID)""", "N3")
def _(t):
    return I.with_plain_share(monthly(t), t.care).select("ADM2_ID", "YEAR", "MONTH", "N3")


@query("H16_admin_names", """
SELECT OU_ID, trim(regexp_replace('XY ' || OU_NAME || ' PROVINCE', '^[A-Z]{2}| PROVINCE', '', 'g')) AS stripped,
  CASE WHEN s_acctbal > 9000 THEN 'FERMEE' ELSE '' END AS short
FROM v_pyramid JOIN supplier ON OU_ID = 'F' || s_suppkey""")
def _(t):
    full = F.concat(F.lit("XY "), "OU_NAME", F.lit(" PROVINCE"))
    return t.pyramid.select("OU_ID", X.strip_country_prefix(full, "PROVINCE").alias("stripped"),
                            X.short_admin_name(F.concat("OU_NAME", F.lit(" Province"))).alias("short"))


@query("H17_facility_type", "SELECT OU_ID, type FROM v_typed")
def _(t):
    from .checks_agg import named_facilities

    return named_facilities(t).select("OU_ID", X.facility_type("OU_NAME").alias("type"))


@query("H18_title_case", """
SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part""")
def _(t):
    return t.raw_table("part").select("p_partkey", X.title_case(F.upper("p_name")).alias("title"))


@query("H19_year_month_label", """
SELECT ADM2_ID, YEAR || '-' || lpad(CAST(MONTH AS VARCHAR), 2, '0') AS label FROM v_district_month""")
def _(t):
    return t.district_month.select("ADM2_ID", Pd.year_month_label("YEAR", "MONTH").alias("label"))


@query("H20_bin_left_closed", """
SELECT OU_ID, PERIOD, CASE WHEN ALLOUT < 50 THEN '< 50%' WHEN ALLOUT < 100.5 THEN '[50-100.5)%' WHEN ALLOUT <= 300 THEN '>= 100.5%' END AS class
FROM v_routine""")
def _(t):
    return t.routine.select("OU_ID", "PERIOD", B.cut_half_open("ALLOUT", [0, 50, 100.5, 300]).alias("class"))


@query("H20_bin_thousands", """
SELECT ADM2_ID, YEAR, CASE WHEN v <= 1000 THEN '< 1k' WHEN v <= 1500 THEN '1 - 1.5k' WHEN v <= 4000 THEN '1.5 - 4k' ELSE '> 4k' END AS class
FROM (SELECT ADM2_ID, YEAR, POPULATION AS v FROM v_population)""")
def _(t):
    return t.population.select("ADM2_ID", "YEAR", B.cut_thousands("POPULATION", [1000, 1500, 4000]).alias("class"))


@query("H20_bin_right_closed", """
SELECT OU_ID, PERIOD, CASE WHEN ALLOUT >= 0 AND ALLOUT <= 50 THEN 0 WHEN ALLOUT <= 100 THEN 1 WHEN ALLOUT <= 300 THEN 2 END AS class
FROM v_routine""")
def _(t):
    return t.routine.select("OU_ID", "PERIOD", B.bin_index("ALLOUT", [0, 50, 100, 300], right=True).alias("class"))


@query("H21_int_as_text", """
SELECT OU_ID, PERIOD, coalesce(CAST(CAST(MALDTH AS INTEGER) AS VARCHAR), '<=60%') AS MALDTH FROM v_routine""")
def _(t):
    return t.routine.select("OU_ID", "PERIOD", B.int_text(F.col("MALDTH").cast("int")).alias("MALDTH"))


@query("H22_rounding", """
SELECT OU_ID, PERIOD, CAST(ceil(ALLOUT / 4) AS DOUBLE) AS up, round_even(ALLOUT / 4, 0) AS even, round(ALLOUT / 4, 1) AS one FROM v_routine""")
def _(t):
    q = F.col("ALLOUT") / 4
    return t.routine.select("OU_ID", "PERIOD", N.ceil_d(q).alias("up"), N.round_even(q).alias("even"), F.round(q, 1).alias("one"))


@query("H23_nan_to_null", """
SELECT OU_ID, PERIOD, CASE WHEN MALDTH = 0 OR MALDTH IS NULL THEN NULL ELSE CONF / MALDTH END AS r FROM v_routine""", "r")
def _(t):
    r = F.when(F.col("MALDTH").isNull() | (F.col("MALDTH") == 0), F.lit(float("nan"))).otherwise(F.col("CONF") / F.col("MALDTH"))
    return t.routine.select("OU_ID", "PERIOD", N.nan_to_null(r).alias("r"))


@query("H24_row_wise_min_and_sum", """
SELECT OU_ID, PERIOD, least(CONF, MALDTH) AS lo, coalesce(CONF, 0) + coalesce(MALDTH, 0) AS total FROM v_routine""")
def _(t):
    return t.routine.select("OU_ID", "PERIOD", F.least("CONF", "MALDTH").alias("lo"), N.row_sum(["CONF", "MALDTH"]).alias("total"))


@query("H25_split_and_join", """
SELECT OU, PE, DX || '.' || CO AS id, DX AS a, CO AS b, DX || ', ' || CO AS joined FROM v_raw""")
def _(t):
    parts = F.split("id", r"\.")
    return t.raw.select("OU", "PE", F.concat_ws(".", "DX", "CO").alias("id")).select(
        "*", F.get(parts, F.lit(0)).alias("a"), F.get(parts, F.lit(1)).alias("b"), F.array_join(parts, ", ").alias("joined"))


@query("H26_hashed_ids", "SELECT OU_ID, substr(sha256(ADM1_ID || '|' || OU_NAME), 1, 11) AS id FROM v_pyramid")
def _(t):
    return t.pyramid.select("OU_ID", X.hashed_id("ADM1_ID", "OU_NAME").alias("id"))


# --- population -------------------------------------------------------------------------------------



def _steps(x, n, back):
    for _ in range(n):
        x = f"round_even({x} / 1.031, 0)" if back else f"round_even({x} * 1.031, 0)"
    return x


def _projection(col, rows, back=6, ahead=6):
    parts = [f"SELECT ADM2_ID, CAST(YEAR + {k} AS INTEGER) AS YEAR, {_steps(col, abs(k), k < 0)} AS POPULATION FROM {rows}"
             for k in range(-back, ahead + 1)]
    return " UNION ALL ".join(parts)


VIEWS["v_ref"] = "SELECT * FROM v_population WHERE YEAR = 1999"


@query("H27_projection", _projection("POPULATION", "v_ref"))
def _(t):
    return Pop.project(t.population.select("ADM2_ID", "YEAR", "POPULATION"), 0.031, year=1999)


@query("H28_scaling", """
SELECT ADM2_ID, YEAR, CAST(round_even(POPULATION * ((SELECT sum(POPULATION) FROM v_population WHERE YEAR = 1998) / 50000.0::DOUBLE), 0) AS INTEGER)
  AS POPULATION FROM v_population""")
def _(t):
    return Pop.scale_to_reference(t.population.select("ADM2_ID", "YEAR", "POPULATION"), 50000, 1998)


@query("H29_fixed_shares", """
SELECT ADM2_ID, YEAR, round_even(POPULATION * 0.185::DOUBLE, 0) AS POP_UNDER_5, round_even(POPULATION * 0.04::DOUBLE, 0) AS POP_PREGNANT_WOMEN FROM v_population""")
def _(t):
    return Pop.add_groups(t.population, {"POP_UNDER_5": 0.185, "POP_PREGNANT_WOMEN": 0.04}).select(
        "ADM2_ID", "YEAR", "POP_UNDER_5", "POP_PREGNANT_WOMEN")


@query("H29_district_shares", """
SELECT ADM2_ID, YEAR, POP_UNDER_5, round_even(POPULATION * PCT, 0) AS POP_NEW FROM v_population LEFT JOIN v_care USING (ADM1_ID)""")
def _(t):
    shares = t.admin.join(t.care, "ADM1_ID").select(
        "ADM1_ID", "ADM2_ID", F.lit(None).cast("string").alias("POP_UNDER_5"), F.col("PCT").alias("POP_NEW"))
    return Pop.add_district_groups(t.population, shares).select("ADM2_ID", "YEAR", "POP_UNDER_5", "POP_NEW")


VIEWS["v_scaled"] = """
SELECT ADM2_ID, YEAR, CAST(round_even(POPULATION * ((SELECT sum(POPULATION) FROM v_population WHERE YEAR = 1999) / 50000.0::DOUBLE), 0) AS INTEGER)
  AS POPULATION FROM v_population WHERE YEAR = 1999"""


@query("K16_population_transformation", _projection("POPULATION", "v_scaled"))
def _(t):
    df = Pop.transform(t.population, 50000, 1999, {"POP_UNDER_5": 0.185}, 0.031)
    return df.select("ADM2_ID", "YEAR", F.col("POPULATION").cast("double").alias("POPULATION"))


# --- positions --------------------------------------------------------------------------------------

# Every unit with its coordinates spoiled in a way that depends on its label.
VIEWS["v_spoiled"] = """
SELECT vec_id AS OU_ID, CASE label WHEN 0 THEN NULL WHEN 1 THEN lat + 20 WHEN 2 THEN -(lon + 10) WHEN 3 THEN (lon + 10) * 1000
    WHEN 4 THEN lon + 10 WHEN 5 THEN 400 ELSE lon + 10 END AS LONGITUDE,
  CASE label WHEN 1 THEN lon + 10 WHEN 2 THEN -(lat + 20) WHEN 3 THEN lat + 20 WHEN 4 THEN (lat + 20) * 100
    WHEN 5 THEN 300 ELSE lat + 20 END AS LATITUDE, label, round(lon + 10, 9) AS good_lon, round(lat + 20, 9) AS good_lat FROM v_cells"""


def _spoiled(t):
    x, y, k = F.col("lon") + 10, F.col("lat") + 20, F.col("label")
    lon = F.when(k == 1, y).when(k == 2, -x).when(k == 3, x * 1000).when(k == 5, 400.0).when(k != 0, x)
    lat = F.when(k == 1, x).when(k == 2, -y).when(k == 4, y * 100).when(k == 5, 300.0).otherwise(y)
    return t.cells.select(F.col("vec_id").alias("OU_ID"), lon.alias("LONGITUDE"), lat.alias("LATITUDE"), "label",
                          F.round(x, 9).alias("good_lon"), F.round(y, 9).alias("good_lat"))


_METHOD = """CASE label WHEN 0 THEN 'MISSING_COORDINATES' WHEN 1 THEN 'SWAP' WHEN 2 THEN 'FLIP_BOTH' WHEN 3 THEN
    CASE WHEN good_lon >= 10 THEN 'DECIMAL_LR_LON_2' ELSE 'DECIMAL_LR_LON_1' END
  WHEN 4 THEN 'DECIMAL_LR_LAT_2' WHEN 5 THEN 'INVALID_NO_MATCH' ELSE 'ORIGINAL' END"""


@query("H7_H8_U4_repair_positions", f"""
SELECT OU_ID, {_METHOD} AS method, label NOT IN (0, 5) AS valid,
  round(CASE WHEN label NOT IN (0, 5) THEN good_lon END, 4) AS lon, round(CASE WHEN label NOT IN (0, 5) THEN good_lat END, 4) AS lat
FROM v_spoiled""")
def _(t):
    out = Fm.repair_positions(_spoiled(t), t.edges, box=(8.0, 12.0, 18.0, 22.0))
    return out.select("OU_ID", F.col("COORD_FIX_METHOD").alias("method"), F.col("COORD_IS_VALID").alias("valid"),
                      F.round("LONGITUDE", 4).alias("lon"), F.round("LATITUDE", 4).alias("lat"))


def _moved(c, k):
    return f"sign({c}) * TRY_CAST(CASE WHEN length(d_{c}) > {k} THEN left(d_{c}, {k}) || '.' || substr(d_{c}, {k + 1}) END AS DOUBLE)"


def _candidate_rows():
    """Every candidate as method, lon, lat, in order of preference."""
    rows = [("ORIGINAL", "lon", "lat"), ("SWAP", "lat", "lon"), ("FLIP_LAT", "lon", "-lat"), ("FLIP_LON", "-lon", "lat"), ("FLIP_BOTH", "-lon", "-lat"),
            ("SWAP_FLIP_LAT", "lat", "-lon"), ("SWAP_FLIP_LON", "-lat", "lon"), ("SWAP_FLIP_BOTH", "-lat", "-lon")]
    for k in (1, 2):
        x, y = _moved("lon", k), _moved("lat", k)
        for swap, one, other in (("", ("lon", "lat"), (x, y)), ("SWAP_", ("lat", "lon"), (y, x))):
            rows += [(f"{swap}DECIMAL_LR_LON_{k}", other[0], one[1]), (f"{swap}DECIMAL_LR_LAT_{k}", one[0], other[1]),
                     (f"{swap}DECIMAL_LR_BOTH_{k}", *other)]
    return rows


VIEWS["v_candidates"] = "SELECT vec_id, c.* FROM (SELECT vec_id, unnest([" + ", ".join(
    f"{{'pos': {n}, 'method': '{m}', 'x': {x}, 'y': {y}}}" for n, (m, x, y) in enumerate(_candidate_rows())) + """]) AS c FROM (
  SELECT *, replace(rtrim(rtrim(CAST(CAST(abs(lon) AS DECIMAL(18, 4)) AS VARCHAR), '0'), '.'), '.', '') AS d_lon,
    replace(rtrim(rtrim(CAST(CAST(abs(lat) AS DECIMAL(18, 4)) AS VARCHAR), '0'), '.'), '.', '') AS d_lat FROM v_cells))"""

VIEWS["v_repaired"] = """
SELECT vec_id, arg_min(method, pos) AS method, arg_min(x, pos) AS lon, arg_min(y, pos) AS lat FROM (
  SELECT c.vec_id, c.pos, any_value(c.method) AS method, any_value(c.x) AS x, any_value(c.y) AS y, e.ADM2_ID,
    sum(CASE WHEN (e.y1 > c.y) != (e.y2 > c.y) AND c.x < (e.x2 - e.x1) * (c.y - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 THEN 1 ELSE 0 END) AS crossings,
    max(CASE WHEN (e.x2 - e.x1) * (c.y - e.y1) - (e.y2 - e.y1) * (c.x - e.x1) = 0 AND c.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
      AND c.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS edge
  FROM v_candidates c CROSS JOIN v_edges e WHERE c.x IS NOT NULL AND c.y IS NOT NULL GROUP BY c.vec_id, c.pos, e.ADM2_ID)
WHERE crossings % 2 = 1 AND edge = 0 GROUP BY vec_id"""


@query("H7_repair_positions_in_country", """
SELECT c.vec_id AS OU_ID, coalesce(r.method, 'INVALID_NO_MATCH') AS method, r.vec_id IS NOT NULL AS valid, r.lon, r.lat
FROM v_cells c LEFT JOIN v_repaired r USING (vec_id)""", "lon lat")
def _(t):
    u = t.cells.select(F.col("vec_id").alias("OU_ID"), F.col("lon").alias("LONGITUDE"), F.col("lat").alias("LATITUDE"))
    out = Fm.repair_positions(u, t.edges, size=SIZE)
    return out.select("OU_ID", F.col("COORD_FIX_METHOD").alias("method"), F.col("COORD_IS_VALID").alias("valid"),
                      F.col("LONGITUDE").alias("lon"), F.col("LATITUDE").alias("lat"))


@query("H9_invalid_positions", "SELECT OU_ID, 'INVALID_NO_MATCH' AS REASON FROM v_spoiled WHERE label = 5")
def _(t):
    out = Fm.repair_positions(_spoiled(t), t.edges, box=(8.0, 12.0, 18.0, 22.0))
    return Fm.invalid_positions(out).select("OU_ID", "REASON")


@query("H9_repairs_by_method", f"SELECT {_METHOD} AS COORD_FIX_METHOD, count(*) AS n FROM v_spoiled GROUP BY 1")
def _(t):
    return Fm.repair_summary(Fm.repair_positions(_spoiled(t), t.edges, box=(8.0, 12.0, 18.0, 22.0)))


# --- formatting jobs --------------------------------------------------------------------------------

_IND = "SUSP TEST CONF PRES ALLOUT".split()


@query("K1_format_routine", f"""
SELECT CAST(r.PE AS INTEGER) AS PERIOD, CAST(substr(r.PE, 1, 4) AS INTEGER) AS YEAR, CAST(substr(r.PE, 5, 2) AS INTEGER) AS MONTH,
  r.OU AS OU_ID, {', '.join(f"max(VALUE) FILTER (WHERE INDICATOR = '{i}') AS {i}" for i in _IND)}, CAST(NULL AS DOUBLE) AS NONE,
  p.ADM1_ID, p.ADM2_ID, replace(p.ADM2_NAME, '_', ' ') AS ADM2_NAME
FROM (SELECT DISTINCT OU, PE FROM v_raw) r LEFT JOIN v_ind i USING (OU, PE) LEFT JOIN v_pyramid p ON p.OU_ID = r.OU
GROUP BY r.OU, r.PE, p.ADM1_ID, p.ADM2_ID, p.ADM2_NAME""")
def _(t):
    return Fm.format_routine(t.raw, indicator_map(t), [*_IND, "NONE"], t.pyramid.select("OU_ID", "ADM1_ID", "ADM2_ID", "ADM2_NAME"))


VIEWS["v_raw_pop"] = """
SELECT 'A' AS DX, CAST(NULL AS VARCHAR) AS CO, ADM2_ID AS OU, CAST(YEAR AS VARCHAR) AS PE, CASE WHEN YEAR > 1996 THEN CAST(CAST(POPULATION AS BIGINT) AS VARCHAR) || '.7' END AS VALUE
FROM v_population
UNION ALL SELECT 'N', 'F', ADM2_ID, CAST(YEAR AS VARCHAR), CAST(CAST(POP_UNDER_5 AS BIGINT) AS VARCHAR) FROM v_population"""


@query("K2_format_population", """
SELECT a.ADM1_ID, a.ADM2_ID, replace(a.ADM2_NAME, '_', ' ') AS ADM2_NAME, y.YEAR, x.SUSP, x.ALLOUT
FROM v_admin a CROSS JOIN (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS YEAR) y
LEFT JOIN (SELECT OU, CAST(PE AS INTEGER) AS YEAR, sum(coalesce(trunc(CAST(VALUE AS DOUBLE)), 0)) FILTER (WHERE DX = 'A') AS SUSP,
  sum(coalesce(trunc(CAST(VALUE AS DOUBLE)), 0)) AS ALLOUT FROM v_raw_pop GROUP BY 1, 2) x ON x.OU = a.ADM2_ID AND x.YEAR = y.YEAR""")
def _(t):
    p = t.population
    whole = F.when(F.col("YEAR") > 1996, F.concat(F.col("POPULATION").cast("bigint").cast("string"), F.lit(".7")))
    a = p.select(F.lit("A").alias("DX"), F.lit(None).cast("string").alias("CO"), F.col("ADM2_ID").alias("OU"),
                                       F.col("YEAR").cast("string").alias("PE"), whole.alias("VALUE"))
    b = p.select(F.lit("N").alias("DX"), F.lit("F").alias("CO"), F.col("ADM2_ID").alias("OU"),
                 F.col("YEAR").cast("string").alias("PE"), F.col("POP_UNDER_5").cast("bigint").cast("string").alias("VALUE"))
    return Fm.format_population(a.unionByName(b), indicator_map(t), ["SUSP", "ALLOUT"],
                                t.admin.select("ADM1_ID", "ADM2_ID", "ADM2_NAME"), list(range(1995, 2002)))


@query("K3_format_pyramid", """
SELECT u.vec_id AS OU_ID, 'UNIT A ' || u.vec_id AS OU_NAME, coalesce(r.method, 'INVALID_NO_MATCH') AS COORD_FIX_METHOD,
  r.lon AS LONGITUDE, r.lat AS LATITUDE FROM v_cells u LEFT JOIN v_repaired r USING (vec_id)""", "LONGITUDE LATITUDE")
def _(t):
    raw = t.cells.select(F.col("vec_id").alias("OU_ID"), F.concat(F.lit(" Unit-à_"), "vec_id").alias("OU_NAME"),
                         G.point_text("lon", "lat").alias("GEOMETRY"))
    out = Fm.format_pyramid(raw, t.edges, "OU_ID", SIZE)
    return out.select("OU_ID", "OU_NAME", "COORD_FIX_METHOD", "LONGITUDE", "LATITUDE")


@query("K4_format_reporting", """
SELECT r.PERIOD, r.YEAR, r.MONTH, r.OU_ID, r.PRODUCT_UID, CASE r.PRODUCT_UID WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS PRODUCT_NAME,
  r.PRODUCT_METRIC, r.VALUE, p.ADM2_ID FROM v_reports r LEFT JOIN (SELECT DISTINCT OU_ID, ADM2_ID FROM v_reports) p USING (OU_ID)""")
def _(t):
    raw = t.reports.select(F.concat_ws(".", "PRODUCT_UID", "PRODUCT_METRIC").alias("dx"), F.col("OU_ID").alias("ou"),
                           F.col("PERIOD").cast("string").alias("pe"), F.col("VALUE").cast("string").alias("value"))
    return Fm.format_reporting(raw, {"F": "Finished", "O": "Open"}, t.reports.select("OU_ID", "ADM2_ID").distinct())


@query("K5_format_shapes", """
SELECT DISTINCT ADM1_NAME, ADM1_ID, replace(ADM2_NAME, '_', ' ') AS ADM2_NAME, ADM2_ID FROM v_pyramid""")
def _(t):
    s = t.pyramid.select(F.col("ADM1_ID").alias("LEVEL_2_ID"), F.col("ADM1_NAME").alias("LEVEL_2_NAME"),
                         F.col("ADM2_ID").alias("LEVEL_3_ID"), F.col("ADM2_NAME").alias("LEVEL_3_NAME"))
    return Fm.format_shapes(s, {"ADM1": 2, "ADM2": 3})




@query("K5_A3_shape_edges", """
SELECT ADM2_ID, r.ring, CAST(seq AS INTEGER) AS seq, CASE r.ring WHEN 0 THEN x1 ELSE round(x1 / 2, 6) END AS x1,
  CASE r.ring WHEN 0 THEN y1 ELSE round(y1 / 2, 6) END AS y1, CASE r.ring WHEN 0 THEN x2 ELSE round(x2 / 2, 6) END AS x2,
  CASE r.ring WHEN 0 THEN y2 ELSE round(y2 / 2, 6) END AS y2
FROM v_edges CROSS JOIN (VALUES (0), (1)) r(ring)""", "x1 y1 x2 y2")
def _(t):
    from ..operators.spatial import polygon_edges

    e = t.edges

    def ring(scale):
        point = F.format_string("[%.9f,%.9f]", F.col("x1") * scale, F.col("y1") * scale)
        order = F.array_sort(F.collect_list(F.struct("seq", point.alias("p"))))
        points = F.transform(order, lambda s: s["p"])
        return F.concat(F.lit("["), F.array_join(F.concat(points, F.slice(points, 1, 1)), ","), F.lit("]"))

    # every shape as a Polygon with a second ring half its size, odd labels as a MultiPolygon
    shapes = e.groupBy("ADM2_ID").agg(ring(1.0).alias("a"), ring(0.5).alias("b"))
    multi = F.col("ADM2_ID").isin("L1", "L3", "L5", "L7", "L9")
    text = F.when(multi, F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), "a", F.lit("],["), "b", F.lit("]]}"))).otherwise(
        F.concat(F.lit('{"type":"Polygon","coordinates":['), "a", F.lit(","), "b", F.lit("]}")))
    return polygon_edges(shapes.select("ADM2_ID", text.alias("GEOMETRY")), ["ADM2_ID"])
