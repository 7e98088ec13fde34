"""Sources, sinks and simple projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nulls import to_num, to_num_blank
from ..functions.text import clean_columns
from ..operators import joins as J
from ..operators import keys as K
from ..operators import shape as H
from ..operators.spatial import usable_edges
from ..plans import assemble as Z
from ..plans import formatting as Fm
from ..plans import incidence as I
from ..plans import survey as V
from ..sources import config as Cf
from ..sources import readers as Rd
from ..sources.staging import new_path
from ..streaming.incremental import missing_periods
from .checks_join import indicator_map
from .registry import query
from .standins import INDICATORS, VIEWS


@query("A1_latest_version", """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS version FROM lineitem
WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)""")
def _(t):
    df = Rd.read_table(t.spark, f"{t.dir}/lineitem.parquet").withColumn("version", F.year("l_shipdate"))
    return Rd.latest_version(df).select("l_orderkey", "l_linenumber", "version")


@query("A2_read_with_required_columns", """
SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem""")
def _(t):
    df = Rd.read_country_table(t.spark, t.dir, "line", "item.parquet", "routine data", ["l_orderkey", "l_quantity"],
                               {"l_quantity": "int"})
    return df.select("l_orderkey", "l_quantity")


@query("A3_H5_point_geometry", """
SELECT vec_id, CASE WHEN label = 0 THEN NULL WHEN label = 1 THEN NULL ELSE lon END AS LONGITUDE,
  CASE WHEN label = 0 THEN NULL WHEN label = 1 THEN NULL ELSE lat END AS LATITUDE, label > 1 AS PARSE_OK FROM v_cells""",
       "LONGITUDE LATITUDE")
def _(t):
    from ..functions.geo import point_text

    text = F.when(F.col("label") == 0, "").when(F.col("label") == 1, '{"type": "Point", "coordinates": [1')
    df = t.cells.withColumn("GEOMETRY", text.otherwise(point_text("lon", "lat")))
    return Rd.with_point_columns(df.select("vec_id", "GEOMETRY"))


@query("A4_facility_points", """
SELECT vec_id, lat AS LATITUDE, lon AS LONGITUDE FROM v_cells""", "LATITUDE LONGITUDE")
def _(t):
    df = t.cells.select("vec_id", F.col("lat").alias("Latitude"), F.col("lon").alias("longitude"))
    return Rd.facility_points(df)


@query("A4_bad_coordinates", """
SELECT count(*) FILTER (WHERE DX = 'A' AND VALUE IS NOT NULL AND try_cast(VALUE AS DOUBLE) IS NULL) AS LATITUDE,
  count(*) FILTER (WHERE VALUE IS NOT NULL AND try_cast(VALUE AS DOUBLE) IS NULL) AS LONGITUDE FROM v_raw""")
def _(t):
    df = t.raw.select(F.when(F.col("DX") == "A", F.col("VALUE")).alias("LATITUDE"), F.col("VALUE").alias("LONGITUDE"))
    return Rd.bad_coordinates(df)


@query("A5_first_available_source", "SELECT ADM1_ID, PCT FROM v_care", "PCT")
def _(t):
    file = Rd.read_first_available(t.spark, [None, f"{t.dir}/no_such_file.parquet"])
    return t.care if file is None else file


@query("A5_user_file_wins", "SELECT ADM1_ID, PCT / 2 AS PCT FROM v_care", "PCT")
def _(t):
    """A file of the user comes before the one that ships with the survey; both exist."""
    own, shipped = (f"{new_path(t.spark)}.parquet" for _ in range(2))
    t.care.write.parquet(shipped)
    t.care.withColumn("PCT", F.col("PCT") / 2).write.parquet(own)
    return Rd.read_first_available(t.spark, [f"{t.dir}/no_such_file.parquet", own, shipped]).select("ADM1_ID", "PCT")


@query("A6_merge_period_files", """
SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS" FROM orders""")
def _(t):
    df = Rd.merge_period_files(t.spark, f"{t.dir}/orders*.parquet")
    return df.select("O_ORDERKEY", "O_CUSTKEY", "O_ORDERSTATUS")


@query("A6_period_file_ledger", """
SELECT 'nation.parquet' AS file, count(*) AS n_rows, true AS merged FROM nation UNION ALL SELECT 'region.parquet', count(*), true FROM region
UNION ALL SELECT 'broken.parquet', 0, false""")
def _(t):
    """Copies of two tables and one file that is no table: the merge goes on, the ledger names it."""
    folder = new_path(t.spark)
    for name in ("nation", "region"):
        t.raw_table(name).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    t.spark.range(1).select(F.lit("not a table").alias("value")).coalesce(1).write.text(f"{folder}/broken.parquet")
    ledger = Rd.period_file_ledger(t.spark, f"{folder}/*.parquet/part-*", level=-2)
    return ledger.select("file", "n_rows", "merged")


@query("A7_concat_tables", """
SELECT n_nationkey, n_name, NULL AS r_name FROM nation UNION ALL SELECT NULL, NULL, r_name FROM region""")
def _(t):
    return Rd.concat_tables(t.spark, [f"{t.dir}/nation.parquet", f"{t.dir}/region.parquet"]).select(
        "n_nationkey", "n_name", "r_name")


@query("A8_missing_periods", """
SELECT OU, PE, DX, CO FROM v_raw WHERE PE NOT IN (SELECT PE FROM v_raw WHERE try_cast(VALUE AS DOUBLE) > 150)""")
def _(t):
    return missing_periods(t.raw, t.raw.filter(to_num("VALUE") > 150)).select("OU", "PE", "DX", "CO")


@query("A11_cells_with_nodata", "SELECT lon, lat, CASE WHEN label <> 3 THEN value END AS value FROM v_cells", "value")
def _(t):
    df = t.cells.withColumn("v", F.when(F.col("label") == 3, -9999.0).otherwise(F.col("value")))
    return Rd.cell_table(df, "lon", "lat", "v", nodata=-9999.0)


# Definitions are configuration; the query applies them to the whole raw table.
@query("A12_definitions_on_data", """
SELECT m.INDICATOR, m.DX, m.CO, count(r.OU) AS n FROM v_indmap m LEFT JOIN v_raw r
  ON r.DX = m.DX AND (m.CO IS NULL OR r.CO = m.CO) GROUP BY ALL""")
def _(t):
    per = t.raw.groupBy("DX", "CO").agg(F.count(F.lit(1)).alias("n"))
    m = indicator_map(t).alias("m")
    r = per.alias("r")
    same = (F.col("m.DX") == F.col("r.DX")) & (F.col("m.CO").isNull() | (F.col("m.CO") == F.col("r.CO")))
    return m.join(r, same, "left").groupBy("m.INDICATOR", "m.DX", "m.CO").agg(F.coalesce(F.sum("r.n"), F.lit(0)).alias("n"))


@query("A13_defined_elements_in_data", """
SELECT DX, count(*) AS n FROM v_raw WHERE DX IN (SELECT DX FROM v_indmap) GROUP BY 1""")
def _(t):
    return t.raw.join(Cf.element_ids(indicator_map(t)), "DX", "left_semi").groupBy("DX").agg(F.count(F.lit(1)).alias("n"))


@query("A14_metadata_with_periods", """
SELECT 'POPULATION' AS VARIABLE, 'Population' AS LABEL, CAST((SELECT max(YEAR) FROM v_population) AS VARCHAR) AS PERIOD
UNION ALL SELECT 'CONF', 'Confirmed cases', '2000'""")
def _(t):
    meta = Cf.metadata_table(t.spark, {"POPULATION": {"LABEL": "Population", "PERIOD": None},
                                       "CONF": {"LABEL": "Confirmed cases", "PERIOD": "2000"}})
    updates = t.population.agg(F.max("YEAR").cast("string").alias("PERIOD")).withColumn("VARIABLE", F.lit("POPULATION"))
    return Cf.update_metadata(meta, updates)


@query("A15_code_labels", "SELECT DISTINCT ADM1_NAME AS DHS_ADM1_NAME, V024 AS DHS_ADM1_CODE FROM v_survey")
def _(t):
    return Cf.code_labels(t.survey, "V024", "ADM1_NAME", "DHS_ADM1_CODE", "DHS_ADM1_NAME")


@query("A16_empty_template", """
SELECT DISTINCT ADM1_ID, ADM2_ID, CAST(NULL AS DOUBLE) AS POP_A, CAST(NULL AS DOUBLE) AS POP_B FROM v_pyramid""")
def _(t):
    return H.empty_template(t.pyramid, ["ADM1_ID", "ADM2_ID"], ["POP_A", "POP_B"])


# --- projections ------------------------------------------------------------------------------------


@query("B1_clean_column_names", 'SELECT l_orderkey AS "L_ORDERKEY", l_quantity AS "L_QUANTITY__KG_" FROM lineitem')
def _(t):
    df = t.raw_table("lineitem").select("l_orderkey", F.col("l_quantity").alias(" l quantity (kg)".strip()))
    return clean_columns(df.withColumnRenamed("l quantity (kg)", "l_quantity (kg)"))


@query("B2_admin_columns", """
SELECT DISTINCT ADM1_ID, ADM1_NAME, ADM2_ID, ADM2_NAME FROM v_pyramid""")
def _(t):
    levels = t.pyramid.select(F.col("ADM1_ID").alias("LEVEL_2_ID"), F.col("ADM1_NAME").alias("LEVEL_2_NAME"),
                              F.col("ADM2_ID").alias("LEVEL_3_ID"), F.col("ADM2_NAME").alias("LEVEL_3_NAME"))
    return Fm.admin_table(levels, {"ADM1": 2, "ADM2": 3})


@query("B3_cast_columns", """
SELECT OU, try_cast(PE AS INTEGER) AS PE, try_cast(VALUE AS DOUBLE) AS VALUE FROM v_raw""")
def _(t):
    return H.cast_columns(t.raw.select("OU", "PE", "VALUE"), {"PE": "int", "VALUE": "double"})


@query("B3_cast_like_reference", """
SELECT OU AS OU_ID, try_cast(PE AS INTEGER) AS PERIOD, try_cast(VALUE AS DOUBLE) AS CONF FROM v_raw""")
def _(t):
    df = t.raw.select(F.col("OU").alias("OU_ID"), F.col("PE").alias("PERIOD"), F.col("VALUE").alias("CONF"))
    return H.cast_like(df, t.routine.select("OU_ID", "PERIOD", "CONF"))


@query("B4_numbers_with_blanks", """
SELECT OU, PE, DX, CO, try_cast(VALUE AS DOUBLE) AS VALUE FROM v_raw""")
def _(t):
    text = F.when(F.col("VALUE") == "n/a", " - ").when(F.col("VALUE").isNull(), "").otherwise(F.col("VALUE"))
    return t.raw.select("OU", "PE", "DX", "CO", to_num_blank(text).alias("VALUE"))


@query("B5_numbers", "SELECT OU, PE, DX, CO, try_cast(VALUE AS DOUBLE) AS VALUE FROM v_raw")
def _(t):
    return t.raw.select("OU", "PE", "DX", "CO", to_num("VALUE").alias("VALUE"))


@query("B7_units_at_level", "SELECT id, name FROM v_units WHERE level = 3 AND starts_with(name, 'UNIT 1')")
def _(t):
    from .checks_join import units

    return Fm.units_at_level(units(t), 3, "UNIT 1").select("id", "name")


@query("B12_year_window", """
SELECT ADM2_ID, PERIOD FROM v_district_month WHERE YEAR >= (SELECT max(YEAR) FROM v_district_month) - 1""")
def _(t):
    return Z.year_window(t.district_month, -2).select("ADM2_ID", "PERIOD")


@query("B13_survey_universes", """
SELECT 'fever' AS u, CASEID FROM v_survey WHERE n_open > 0 AND age < 60 AND n_urgent > 0
UNION ALL SELECT 'tested', CASEID FROM v_survey WHERE age BETWEEN 6 AND 59 AND n_open > 0 AND n_urgent > 0
UNION ALL SELECT 'vaccine', CASEID FROM v_survey WHERE n_open > 0 AND n_urgent >= 1 AND age < 36""")
def _(t):
    yes = (F.col("n_open") > 0).cast("int")
    urgent = (F.col("n_urgent") > 0).cast("int")
    kids = t.survey.select("CASEID", yes.alias("B5"), F.col("age").alias("B19"), urgent.alias("H22"), F.col("n_urgent").alias("B8"),
                           F.col("age").alias("HC1"), yes.alias("HV103"), urgent.alias("HV042"))
    parts = {"fever": V.fever_children(kids), "tested": V.tested_children(kids), "vaccine": V.vaccination_children(kids)}
    return H.union_all([df.select(F.lit(u).alias("u"), "CASEID") for u, df in parts.items()])


@query("B14_choose_group", """
SELECT OU_ID, PERIOD, MALADM AS SUSP, ALLADM AS TEST, MALDTH AS CONF FROM v_routine""")
def _(t):
    df = t.routine.withColumnsRenamed({"MALADM": "SUSP_UNDER_5", "ALLADM": "TEST_UNDER_5", "MALDTH": "CONF_UNDER_5"})
    return I.choose_group(df, "UNDER_5", "SUSP-TEST").select("OU_ID", "PERIOD", "SUSP", "TEST", "CONF")


@query("B15_choose_population", "SELECT ADM2_ID, YEAR, POP_UNDER_5 AS POPULATION FROM v_population")
def _(t):
    return I.choose_population(t.population, "UNDER_5").select("ADM2_ID", "YEAR", "POPULATION")


@query("B16_routine_variant", f"""
SELECT OU_ID, PERIOD, INDICATOR, VALUE_IMPUTED AS VALUE FROM v_flag_iqr WHERE INDICATOR IN {tuple(INDICATORS)}""")
def _(t):
    from ..plans.outliers import detect
    from ..sources.staging import new_path, stage

    flagged = stage(detect(t.long, "IQR").select("OU_ID", "PERIOD", "INDICATOR", "VALUE", "VALUE_IMPUTED"))
    path = new_path(t.spark)
    # a folder for each variant, as a table partitioned by it has, written without sorting the rows by variant
    for variant, value in (("raw", "VALUE"), ("imputed", "VALUE_IMPUTED")):
        flagged.select("OU_ID", "PERIOD", "INDICATOR", F.col(value).alias("VALUE")).write.parquet(f"{path}/variant={variant}")
    return Rd.read_variant(t.spark, path, "imputed")


@query("B18_month_of_reference_years", """
SELECT ADM2_ID, YEAR, CONF FROM v_district_month WHERE MONTH = 8 AND YEAR IN (1996, 1998)""")
def _(t):
    cols = H.columns_matching(t.district_month, "^CON")
    return t.district_month.filter((F.col("MONTH") == 8) & F.col("YEAR").isin(1996, 1998)).select("ADM2_ID", "YEAR", *cols)


@query("B19_first_areas", """
SELECT OU_ID, PERIOD, ADM1_ID FROM v_routine WHERE ADM1_ID IN (SELECT DISTINCT ADM1_ID FROM v_routine ORDER BY 1 LIMIT 2)""")
def _(t):
    return K.in_first_groups(t.routine, "ADM1_ID", 2).select("OU_ID", "PERIOD", "ADM1_ID")


@query("B20_drop_all_missing", """
SELECT OU_ID, PERIOD, MALDTH, MALADM FROM v_routine WHERE MALDTH IS NOT NULL OR MALADM IS NOT NULL""")
def _(t):
    return H.drop_all_missing(t.routine.select("OU_ID", "PERIOD", "MALDTH", "MALADM"), ["MALDTH", "MALADM"])


@query("B21_padded_columns", """
SELECT OU_ID, PERIOD, CONF, CAST(NULL AS DOUBLE) AS NOT_THERE, CAST(NULL AS VARCHAR) AS NO_NAME FROM v_routine""")
def _(t):
    return H.pad_columns(t.routine, ["OU_ID", "PERIOD", "CONF", "NOT_THERE", "NO_NAME"], {"NOT_THERE": "double"})


@query("B22_care_seeking_percent", "SELECT ADM1_ID, PCT * 100 AS CARESEEKING_PCT FROM v_care", "CARESEEKING_PCT")
def _(t):
    return I.care_seeking(t.care, "PCT")


@query("B22_care_seeking_percent_form", "SELECT ADM1_ID, PCT * 100 + 1 AS CARESEEKING_PCT FROM v_care", "CARESEEKING_PCT")
def _(t):
    """A file in percents, written as text, stays as it is; what is no number is refused (tests/test_rules.py)."""
    return I.care_seeking(t.care.withColumn("PCT", (F.col("PCT") * 100 + 1).cast("string")), "PCT")


@query("B23_constant_level_names", "SELECT OU_ID, 'Region' AS LEVEL_2, 'District' AS LEVEL_3 FROM v_pyramid")
def _(t):
    return H.constant_columns(t.pyramid.select("OU_ID"), {"LEVEL_2": "Region", "LEVEL_3": "District"})


@query("B24_usable_shapes", """
SELECT ADM2_ID, seq FROM v_edges WHERE ADM2_ID NOT IN ('L1', 'L2')""")
def _(t):
    broken = t.edges.withColumn("x1", F.when((F.col("ADM2_ID") == "L1") & (F.col("seq") > 2), None).otherwise(F.col("x1")))
    return usable_edges(broken.filter("not (ADM2_ID = 'L2' and seq > 1)"), "ADM2_ID").select("ADM2_ID", "seq")


@query("B25_H25_group_members", """
SELECT 'G' || s_nationkey AS id, n_name AS name, 'F' || s_suppkey AS OU_ID FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE lower(n_name) IN ('nation_3', 'nation_15', 'nation_16')""")
def _(t):
    # a group table holds its members as a list per row; here each facility contributes its own one-member row
    s = t.raw_table("supplier")
    n = t.raw_table("nation")
    groups = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("G"), "s_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.array(F.concat(F.lit("F"), "s_suppkey")).alias("organisation_units"))
    return Cf.group_members(groups, ["Nation_3", "NATION_15", "nation_16"])


# --- sorting and picking ----------------------------------------------------------------------------


@query("F1_F5_ordered_coverage", """
SELECT OU_ID, count(MALDTH) AS n FROM v_routine GROUP BY 1 ORDER BY n DESC, OU_ID""")
def _(t):
    return K.most_complete_first(t.routine, "OU_ID", "MALDTH")


@query("F3_first_groups", "SELECT DISTINCT ADM2_ID FROM v_routine ORDER BY 1 LIMIT 5")
def _(t):
    return K.first_groups(t.routine, "ADM2_ID", 5)


VIEWS["v_files"] = """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'BFPR' ELSE 'BFKR' END || (o_orderkey % 83) || 'SV.zip' AS name, o_orderkey FROM orders"""


def _files(t):
    k = F.col("o_orderkey")
    name = F.concat(F.when(k % 2 == 0, "BFPR").otherwise("BFKR"), (k % 83).cast("string"), F.lit("SV.zip"))
    return t.raw_table("orders").select(name.alias("name"), "o_orderkey")


@query("F4_latest_named_version", """
SELECT name, o_orderkey FROM v_files WHERE regexp_matches(name, '(?i)PR.*SV\\.zip$')
  AND CAST(regexp_replace(name, '\\D', '', 'g') AS BIGINT) =
    (SELECT max(CAST(regexp_replace(name, '\\D', '', 'g') AS BIGINT)) FROM v_files WHERE regexp_matches(name, '(?i)PR.*SV\\.zip$'))""")
def _(t):
    return Rd.latest_named(_files(t), "name", r"(?i)PR.*SV\.zip$")


@query("F4_latest_year_rows", """
SELECT ADM2_ID, POPULATION FROM v_population WHERE YEAR = (SELECT max(YEAR) FROM v_population)""")
def _(t):
    p = t.population
    return p.filter(F.col("YEAR") == p.agg(F.max("YEAR")).scalar()).select("ADM2_ID", "POPULATION")


@query("H33_metric_file_names", """
SELECT o_orderkey, 'Malaria' AS METRIC_CATEGORY, '202508' AS VERSION, 'Global' AS REGION, 'Pf_' || o_orderstatus || '_Rate' AS METRIC_NAME,
  CAST(year(o_orderdate) AS INTEGER) AS YEAR FROM orders""")
def _(t):
    path = F.concat(F.lit("/data/Malaria__202508_Global_Pf_"), "o_orderstatus", F.lit("_Rate_"), F.year("o_orderdate"), F.lit(".tif"))
    return Rd.metric_from_file_name(t.raw_table("orders").select("o_orderkey", path.alias("path"))).drop("path")


@query("H34_metric_names", """
SELECT PERIOD, OU_ID, PRODUCT_METRIC, CASE PRODUCT_UID WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS PRODUCT_NAME, p.ADM2_NAME
FROM v_reports r LEFT JOIN v_admin p USING (ADM2_ID)""")
def _(t):
    names = Cf.metric_names({"Finished": "F", "Open": "O"}, "PRODUCT_UID")
    df = t.reports.select("PERIOD", "OU_ID", "ADM2_ID", "PRODUCT_METRIC", names.alias("PRODUCT_NAME"))
    return J.attach(df, t.admin, ["ADM2_ID"], ["ADM2_NAME"]).drop("ADM2_ID")




@query("A9_written_and_read_back", "SELECT OU_ID, PERIOD, SUSP, CONF FROM v_routine")
def _(t):
    return t.staged_routine.select("OU_ID", "PERIOD", "SUSP", "CONF")


@query("A10_catalog_table", "SELECT OU_ID, PERIOD, CONF FROM v_routine")
def _(t):
    from ..sources.staging import new_path
    from ..sources.writers import push_to_database

    name = new_path(t.spark).rsplit("/", 1)[1]
    push_to_database(t.routine.select("OU_ID", "PERIOD", "CONF"), f"pushed_{name}")
    return t.spark.table(f"pushed_{name}")


@query("A9_csv_and_per_year", "SELECT OU_ID, PERIOD, YEAR, CONF FROM v_routine")
def _(t):
    from ..sources.staging import new_path
    from ..sources.writers import write_per_year, write_table

    csv, yearly = new_path(t.spark) + ".csv", new_path(t.spark)
    write_table(t.routine.select("OU_ID", "PERIOD", "YEAR", "CONF"), csv)
    write_per_year(Rd.read_table(t.spark, csv, "OU_ID string, PERIOD int, YEAR int, CONF double"), yearly)
    return t.spark.read.parquet(yearly).select("OU_ID", "PERIOD", F.col("YEAR").cast("int").alias("YEAR"), "CONF")
