"""Window operators and the outlier, seasonality jobs built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as S
from ..operators.keys import duplicate_keys, first_per_key
from ..operators.shape import long_many, wide_many
from ..plans import outliers as O
from ..plans import seasonality as Z
from .registry import query
from .standins import INDICATORS, VIEWS

KEY = "ADM1_ID, ADM2_ID, OU_ID, INDICATOR"

VIEWS["v_stats"] = f"""
SELECT s.*, CAST(ceil(median(abs(VALUE - raw_median)) OVER k) AS DOUBLE) AS MAD FROM (
  SELECT l.*, median(VALUE) OVER k AS raw_median,
    CAST(ceil(avg(VALUE) OVER k) AS DOUBLE) AS MEAN, CAST(ceil(median(VALUE) OVER k) AS DOUBLE) AS MEDIAN,
    CAST(ceil(stddev_samp(VALUE) OVER k) AS DOUBLE) AS SD,
    CAST(ceil(quantile_cont(VALUE, 0.25) OVER k) AS DOUBLE) AS Q1,
    CAST(ceil(quantile_cont(VALUE, 0.75) OVER k) AS DOUBLE) AS Q3
  FROM v_long l WINDOW k AS (PARTITION BY {KEY})) s
WINDOW k AS (PARTITION BY {KEY})"""

FLAG_SQL = {
    "IQR": "VALUE < Q1 - 1.5 * (Q3 - Q1) OR VALUE > Q3 + 1.5 * (Q3 - Q1)",
    "MEAN": "VALUE < MEAN - 3 * SD OR VALUE > MEAN + 3 * SD",
    "MEDIAN": "VALUE < MEDIAN - 3 * MAD OR VALUE > MEDIAN + 3 * MAD",
}
for method, cond in FLAG_SQL.items():
    how = "median" if method == "MEDIAN" else "avg"
    VIEWS[f"v_flag_{method.lower()}"] = f"""
SELECT * EXCLUDE (kept), coalesce(kept, CASE WHEN count(*) OVER near = 3
    THEN CAST(ceil({how}(kept) OVER near) AS DOUBLE) END) AS VALUE_IMPUTED
FROM (SELECT *, CASE WHEN NOT OUTLIER THEN VALUE END AS kept
      FROM (SELECT *, coalesce({cond}, false) AS OUTLIER FROM v_stats))
WINDOW near AS (PARTITION BY {KEY} ORDER BY PERIOD ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""

DETECTED = """SELECT d.PERIOD, d.YEAR, d.MONTH, d.ADM1_ID, d.ADM2_ID, d.OU_ID, d.INDICATOR, d.VALUE,
  d.OUTLIER AS OUTLIER_DETECTED, '{method}' AS OUTLIER_METHOD,
  strftime(make_date(d.YEAR, d.MONTH, 1), '%Y-%m-%d') AS DATE, p.ADM1_NAME, p.ADM2_NAME, p.OU_NAME
FROM {view} d LEFT JOIN v_pyramid p USING (OU_ID)"""

WIDE = """SELECT w.*, p.ADM1_NAME, p.ADM2_NAME, p.OU_NAME FROM (
  SELECT PERIOD, YEAR, MONTH, ADM1_ID, ADM2_ID, OU_ID,
    max({v}) FILTER (WHERE INDICATOR = 'SUSP') AS SUSP, max({v}) FILTER (WHERE INDICATOR = 'TEST') AS TEST,
    max({v}) FILTER (WHERE INDICATOR = 'CONF') AS CONF, max({v}) FILTER (WHERE INDICATOR = 'PRES') AS PRES
  FROM {view} WHERE {where} GROUP BY ALL) w LEFT JOIN v_pyramid p USING (OU_ID)"""


def text_date(df):
    return df.withColumn("DATE", F.date_format("DATE", "yyyy-MM-dd"))


@query("E1_series_statistics", "SELECT * EXCLUDE (raw_median) FROM v_stats")
def _(t):
    return S.series_stats(t.long)


_FLAG_IDS = {"IQR": "E2_iqr_flag", "MEAN": "E3_mean_sd_flag", "MEDIAN": "E4_median_mad_flag"}
_IMPUTE_IDS = {"IQR": "E7_impute_moving_mean", "MEDIAN": "E8_impute_moving_median"}
_JOB_IDS = {"IQR": "K7_outliers_iqr", "MEAN": "K8_outliers_mean", "MEDIAN": "K9_outliers_median"}

for _m in FLAG_SQL:
    view = f"v_flag_{_m.lower()}"
    query(_FLAG_IDS[_m], f"SELECT OU_ID, INDICATOR, PERIOD, VALUE, OUTLIER AS OUTLIER_DETECTED FROM {view}")(
        lambda t, m=_m: O.flag_series(t.long, m).select("OU_ID", "INDICATOR", "PERIOD", "VALUE", "OUTLIER_DETECTED"))
    if _m in _IMPUTE_IDS:
        query(_IMPUTE_IDS[_m], f"SELECT OU_ID, INDICATOR, PERIOD, VALUE, VALUE_IMPUTED FROM {view}")(
            lambda t, m=_m: O.detect(t.long, m).select("OU_ID", "INDICATOR", "PERIOD", "VALUE", "VALUE_IMPUTED"))
    query(f"{_JOB_IDS[_m]}_detected", DETECTED.format(method=_m, view=view))(
        lambda t, m=_m: text_date(O.run(t.routine, INDICATORS, m).detected))
    query(f"{_JOB_IDS[_m]}_imputed", WIDE.format(v="VALUE_IMPUTED", view=view, where="true"))(
        lambda t, m=_m: O.run(t.routine, INDICATORS, m).imputed)
    query(f"{_JOB_IDS[_m]}_removed", WIDE.format(v="VALUE_IMPUTED", view=view, where="NOT OUTLIER"))(
        lambda t, m=_m: O.run(t.routine, INDICATORS, m).removed)


VIEWS["v_staged"] = """
SELECT * EXCLUDE (rest, med2, mad2), OUTLIER_FIRST OR coalesce(rest < med2 - 2 * mad2 OR rest > med2 + 2 * mad2, false)
  AS OUTLIER
FROM (SELECT *, median(abs(rest - med2)) OVER y AS mad2 FROM (
  SELECT *, median(rest) OVER y AS med2 FROM (
    SELECT *, CASE WHEN NOT OUTLIER_FIRST THEN VALUE END AS rest FROM (
      SELECT * EXCLUDE (med, mad), coalesce(VALUE < med - 3 * mad OR VALUE > med + 3 * mad, false) AS OUTLIER_FIRST
      FROM (SELECT *, median(abs(VALUE - med)) OVER y AS mad
            FROM (SELECT *, median(VALUE) OVER y AS med FROM v_long WINDOW y AS (PARTITION BY YEAR, OU_ID, INDICATOR))
            WINDOW y AS (PARTITION BY YEAR, OU_ID, INDICATOR))))
    WINDOW y AS (PARTITION BY YEAR, OU_ID, INDICATOR))
  WINDOW y AS (PARTITION BY YEAR, OU_ID, INDICATOR))"""

@query("E5_mad_flag_by_year", """
SELECT OU_ID, INDICATOR, PERIOD, VALUE, coalesce(VALUE < med - 3 * mad OR VALUE > med + 3 * mad, false) AS OUTLIER
FROM (SELECT *, median(abs(VALUE - med)) OVER y AS mad
      FROM (SELECT *, median(VALUE) OVER y AS med FROM v_long WINDOW y AS (PARTITION BY YEAR, OU_ID, INDICATOR))
      WINDOW y AS (PARTITION BY YEAR, OU_ID, INDICATOR))""")
def _(t):
    return S.mad_flag(t.long, 3, "OUTLIER").select("OU_ID", "INDICATOR", "PERIOD", "VALUE", "OUTLIER")


@query("E6_mad_flag_scaled", """
SELECT OU_ID, INDICATOR, PERIOD, coalesce(VALUE < med - 3 * 1.4826 * mad OR VALUE > med + 3 * 1.4826 * mad, false)
  AS OUTLIER
FROM (SELECT *, median(abs(VALUE - med)) OVER y AS mad
      FROM (SELECT *, median(VALUE) OVER y AS med FROM v_long WINDOW y AS (PARTITION BY OU_ID, INDICATOR))
      WINDOW y AS (PARTITION BY OU_ID, INDICATOR))""")
def _(t):
    return S.mad_flag(t.long, 3, "OUTLIER", ["OU_ID", "INDICATOR"], 1.4826).select(
        "OU_ID", "INDICATOR", "PERIOD", "OUTLIER")


# The staged passes at limits that the smooth stand-in data actually crosses.
@query("K10_outliers_staged_flags", "SELECT OU_ID, INDICATOR, PERIOD, VALUE, OUTLIER_FIRST, OUTLIER FROM v_staged")
def _(t):
    df = O.staged_mad(O.facility_months(t.routine, INDICATORS), INDICATORS, 3, 2)
    df = df.withColumnsRenamed({i: f"VALUE_{i}" for i in INDICATORS} | {f"FIRST_{i}": f"OUTLIER_FIRST_{i}" for i in INDICATORS}
                               | {f"OUT_{i}": f"OUTLIER_{i}" for i in INDICATORS})
    return long_many(df, ["OU_ID", "PERIOD"], "INDICATOR", INDICATORS, ["VALUE", "OUTLIER_FIRST", "OUTLIER"])


VIEWS["v_staged_std"] = VIEWS["v_staged"].replace("2 * mad2", "10 * mad2").replace("3 * mad", "15 * mad")
VIEWS["v_staged_filled"] = f"""
SELECT *, coalesce(kept, CASE WHEN count(*) OVER near = 3 THEN CAST(ceil(avg(kept) OVER near) AS DOUBLE) END) AS filled
FROM (SELECT *, CASE WHEN NOT OUTLIER THEN VALUE END AS kept FROM v_staged_std)
WINDOW near AS (PARTITION BY {KEY} ORDER BY PERIOD ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""


@query("K10_outliers_staged_detected", DETECTED.format(method="MAGIC_GLASSES_PARTIAL", view="v_staged_std"))
def _(t):
    return text_date(O.run_staged(t.routine, INDICATORS).detected)


@query("K10_outliers_staged_imputed", WIDE.format(v="filled", view="v_staged_filled", where="true"))
def _(t):
    return O.run_staged(t.routine, INDICATORS).imputed


@query("K10_outliers_staged_removed", WIDE.format(v="kept", view="v_staged_filled", where="true"))
def _(t):
    return O.run_staged(t.routine, INDICATORS).removed


# The seasonal passes rest on a decomposition that SQL does not have (brute force in tests/test_models.py); rules hold in SQL.


@query("K10_outliers_staged_complete")
def _(t):
    return text_date(O.run_staged(t.routine, INDICATORS, complete=True).detected)


@query("K10_outliers_staged_complete_rules", """
SELECT INDICATOR, count(*) AS n, count(VALUE) AS known, count(*) FILTER (OUTLIER) AS staged, count(*) FILTER (OUTLIER) AS staged_kept,
  CAST(0 AS BIGINT) AS missing_flagged FROM v_staged_std GROUP BY 1""")
def _(t):
    """What the first passes flag stays flagged, rows stay, and a missing value is never an outlier."""
    first = O.run_staged(t.routine, INDICATORS).detected.select("OU_ID", "PERIOD", "INDICATOR", F.col("OUTLIER_DETECTED").alias("staged"))
    both = O.run_staged(t.routine, INDICATORS, complete=True).detected.join(first, ["OU_ID", "PERIOD", "INDICATOR"])
    return both.groupBy("INDICATOR").agg(
        F.count(F.lit(1)).alias("n"), F.count("VALUE").alias("known"), F.count_if("staged").alias("staged"),
        F.count_if(F.col("staged") & F.col("OUTLIER_DETECTED")).alias("staged_kept"),
        F.count_if(F.col("OUTLIER_DETECTED") & F.col("VALUE").isNull()).alias("missing_flagged"))


@query("U1_seasonal_outliers")
def _(t):
    return S.with_seasonal_flag(t.long, 2, "OUTLIER").select("OU_ID", "INDICATOR", "PERIOD", "VALUE", "OUTLIER")


@query("U1_seasonal_outliers_rules", """
SELECT OU_ID, INDICATOR, count(*) AS n, count(VALUE) AS known, CAST(0 AS BIGINT) AS missing_flagged, CAST(0 AS BIGINT) AS flagged_without_spread
FROM v_long GROUP BY ALL""")
def _(t):
    """No row is lost, no missing value is flagged, and no value of a series with under two values or without spread."""
    flagged = S.with_seasonal_flag(t.long, 2, "OUTLIER")
    series = flagged.groupBy("OU_ID", "INDICATOR").agg(
        F.count(F.lit(1)).alias("n"), F.count("VALUE").alias("known"), F.count_if(F.col("OUTLIER") & F.col("VALUE").isNull()).alias("missing_flagged"),
        F.count_if("OUTLIER").alias("flags"), F.array_sort(F.collect_list("VALUE")).alias("v"))
    middle = lambda x: (F.get(x, F.floor((F.size(x) - 1) / 2).cast("int")) + F.get(x, F.floor(F.size(x) / 2).cast("int"))) / 2
    series = series.withColumn("med", middle(F.col("v"))).withColumn("mad", middle(F.array_sort(F.transform("v", lambda x: F.abs(x - F.col("med"))))))
    return series.select("OU_ID", "INDICATOR", "n", "known", "missing_flagged",
                         F.when((F.col("known") < 2) | (F.col("mad") == 0), F.col("flags")).otherwise(0).cast("long").alias("flagged_without_spread"))


VIEWS["v_grid"] = """
SELECT f.ADM1_ID, f.ADM2_ID, f.OU_ID, m.PERIOD, i.INDICATOR, l.VALUE
FROM (SELECT DISTINCT ADM1_ID, ADM2_ID, OU_ID FROM v_long) f
CROSS JOIN (SELECT DISTINCT PERIOD FROM v_long) m CROSS JOIN (SELECT DISTINCT INDICATOR FROM v_long) i
LEFT JOIN v_long l ON l.OU_ID = f.OU_ID AND l.PERIOD = m.PERIOD AND l.INDICATOR = i.INDICATOR"""
VIEWS["v_trim"] = """
SELECT ADM1_ID, ADM2_ID, OU_ID, INDICATOR, CAST(ceil(avg(VALUE)) AS DOUBLE) AS MEAN_80,
  CAST(ceil(stddev_samp(VALUE)) AS DOUBLE) AS SD_80
FROM (SELECT *, row_number() OVER (PARTITION BY OU_ID, INDICATOR ORDER BY VALUE) AS rk,
        count(*) OVER (PARTITION BY OU_ID, INDICATOR) AS n FROM v_long WHERE VALUE > 0)
WHERE rk > n * 0.1::DOUBLE AND rk <= n * 0.9::DOUBLE GROUP BY ALL"""
VIEWS["v_path0"] = """
SELECT g.*, t.MEAN_80, t.SD_80, coalesce(VALUE > MEAN_80 + 2 * SD_80, false)
  AND NOT coalesce(INDICATOR IN ('TEST', 'PRES') AND VALUE < 50, false)
  AND NOT coalesce(INDICATOR = 'CONF' AND VALUE < 10, false) AS trend
FROM v_grid g LEFT JOIN v_trim t USING (ADM1_ID, ADM2_ID, OU_ID, INDICATOR)"""
VIEWS["v_path1"] = """
SELECT a.PERIOD, CAST(a.PERIOD // 100 AS INTEGER) AS YEAR, CAST(a.PERIOD % 100 AS INTEGER) AS MONTH, a.ADM1_ID,
  a.ADM2_ID, a.OU_ID, a.INDICATOR, a.VALUE, a.MEAN_80, a.SD_80,
  a.trend AND NOT coalesce(a.INDICATOR = 'PRES' AND (p.trend AND t.VALUE < t.MEAN_80
    AND p.VALUE < t.MEAN_80 + 2 * t.SD_80), false) AS OUTLIER,
  CASE WHEN p.trend AND t.VALUE < t.MEAN_80 AND p.VALUE < t.MEAN_80 + 2 * t.SD_80 THEN true END AS POSSIBLE_STKOUT,
  CASE WHEN c.trend AND (t.trend OR t.VALUE >= c.VALUE) THEN true END AS POSSIBLE_EPID
FROM v_path0 a
LEFT JOIN v_path0 t ON t.OU_ID = a.OU_ID AND t.PERIOD = a.PERIOD AND t.INDICATOR = 'TEST'
LEFT JOIN v_path0 c ON c.OU_ID = a.OU_ID AND c.PERIOD = a.PERIOD AND c.INDICATOR = 'CONF'
LEFT JOIN v_path0 p ON p.OU_ID = a.OU_ID AND p.PERIOD = a.PERIOD AND p.INDICATOR = 'PRES'"""
VIEWS["v_path2"] = """
SELECT * REPLACE (CASE WHEN undo THEN VALUE ELSE raw_imputed END AS VALUE_IMPUTED, OUTLIER AND NOT undo AS OUTLIER)
FROM (SELECT a.*, a.raw_imputed AS VALUE_IMPUTED, coalesce(a.INDICATOR IN ('TEST', 'CONF')
        AND t.raw_imputed < c.raw_imputed AND t.VALUE > c.VALUE, false) AS undo
  FROM (SELECT *, CASE WHEN OUTLIER THEN MEAN_80 ELSE VALUE END AS raw_imputed FROM v_path1) a
  LEFT JOIN (SELECT *, CASE WHEN OUTLIER THEN MEAN_80 ELSE VALUE END AS raw_imputed FROM v_path1) t
    ON t.OU_ID = a.OU_ID AND t.PERIOD = a.PERIOD AND t.INDICATOR = 'TEST'
  LEFT JOIN (SELECT *, CASE WHEN OUTLIER THEN MEAN_80 ELSE VALUE END AS raw_imputed FROM v_path1) c
    ON c.OU_ID = a.OU_ID AND c.PERIOD = a.PERIOD AND c.INDICATOR = 'CONF')"""


@query("D25_trimmed_statistics", "SELECT * FROM v_trim")
def _(t):
    return S.trimmed_stats(t.long, S.SERIES, ["VALUE"]).withColumnsRenamed(
        {"MEAN_80_VALUE": "MEAN_80", "SD_80_VALUE": "SD_80"}).dropna(subset=["MEAN_80"])


@query("E18_rank_and_group_size", """
SELECT OU_ID, INDICATOR, PERIOD, VALUE,
  CAST(row_number() OVER (PARTITION BY OU_ID, INDICATOR ORDER BY VALUE NULLS FIRST, PERIOD) AS INTEGER) AS rk,
  count(*) OVER (PARTITION BY OU_ID, INDICATOR) AS n FROM v_long""")
def _(t):
    return S.rank_and_size(t.long, ["OU_ID", "INDICATOR"], ["VALUE", "PERIOD"]).select("OU_ID", "INDICATOR", "PERIOD", "VALUE", "rk", "n")


@query("G5_full_grid", "SELECT * FROM v_grid")
def _(t):
    return O.full_grid_long(t.routine, INDICATORS)


@query("K11_pathway_flags", "SELECT * FROM v_path1")
def _(t):
    df = O.pathway_exceptions(O.pathway_flags(O.full_grid(t.routine, INDICATORS), INDICATORS, 2), INDICATORS, 2)
    df = df.withColumnsRenamed({i: f"VALUE_{i}" for i in INDICATORS} | {f"OUT_{i}": f"OUTLIER_{i}" for i in INDICATORS})
    return long_many(df, [*O.FIXED, "POSSIBLE_STKOUT", "POSSIBLE_EPID"], "INDICATOR", INDICATORS,
                     ["VALUE", "MEAN_80", "SD_80", "OUTLIER"])


@query("K11_outliers_pathway_detected", DETECTED.format(method="PATH", view="v_path1"))
def _(t):
    return text_date(O.run_pathway(t.routine, INDICATORS, 2).detected)


@query("K11_outliers_pathway_imputed", WIDE.format(v="VALUE_IMPUTED", view="v_path2", where="true"))
def _(t):
    return O.run_pathway(t.routine, INDICATORS, 2).imputed


@query("K11_outliers_pathway_removed", "SELECT * FROM (" + WIDE.format(
    v="VALUE_IMPUTED", view="v_path2", where="NOT OUTLIER") + ") WHERE NOT (SUSP IS NULL AND TEST IS NULL AND CONF IS NULL AND PRES IS NULL)")
def _(t):
    return O.run_pathway(t.routine, INDICATORS, 2).removed


@query("K11_pathway_imputed_long", """
SELECT PERIOD, YEAR, MONTH, ADM1_ID, ADM2_ID, OU_ID, INDICATOR, VALUE AS VALUE_OLD, VALUE_IMPUTED, OUTLIER AS OUTLIER_TREND
FROM v_path2""")
def _(t):
    grid = O.pathway_flags(O.full_grid(t.routine, INDICATORS), INDICATORS, 2)
    return O.imputed_long(O.pathway_impute(O.pathway_exceptions(grid, INDICATORS, 2), INDICATORS), INDICATORS)


@query("D22_long_with_name_split", """
SELECT PERIOD, OU_ID, INDICATOR, VALUE AS VALUE_OLD, VALUE * 2 AS VALUE_NEW FROM v_long""")
def _(t):
    df = t.long.select("PERIOD", "OU_ID", "INDICATOR", F.col("VALUE").alias("VALUE_OLD"),
                       (F.col("VALUE") * 2).alias("VALUE_NEW"))
    wide = wide_many(df, ["PERIOD", "OU_ID"], "INDICATOR", INDICATORS, ["VALUE_OLD", "VALUE_NEW"])
    return long_many(wide, ["PERIOD", "OU_ID"], "INDICATOR", INDICATORS, ["VALUE_OLD", "VALUE_NEW"])


@query("D23_duplicate_keys", """
SELECT OU_ID, PERIOD, INDICATOR, count(*) AS n FROM v_dup GROUP BY ALL HAVING count(*) > 1""")
def _(t):
    return duplicate_keys(t.dup, ["OU_ID", "PERIOD", "INDICATOR"])


@query("D24_conflicting_reports", """
SELECT PERIOD, OU_ID, coalesce(SUSP, 1.0) AS SUSP, TEST, CONF, PRES FROM v_routine""")
def _(t):
    """Each report three times: as sent, empty, and with SUSP filled in; the fullest counts, then the lowest values."""
    empty = t.routine.withColumns({i: F.lit(None).cast("double") for i in INDICATORS})
    filled = t.routine.withColumn("SUSP", F.coalesce("SUSP", F.lit(1.0)))
    return O.facility_months(t.routine.unionByName(empty).unionByName(filled), INDICATORS).select("PERIOD", "OU_ID", *INDICATORS)


@query("D24_first_row_per_key", """
SELECT OU_ID, PERIOD, INDICATOR, VALUE FROM v_dup
QUALIFY row_number() OVER (PARTITION BY OU_ID, PERIOD, INDICATOR
  ORDER BY l_orderkey, l_linenumber, l_extendedprice, VALUE) = 1""")
def _(t):
    return first_per_key(t.dup, ["OU_ID", "PERIOD", "INDICATOR"],
                         ["l_orderkey", "l_linenumber", "l_extendedprice", "VALUE"]).select(
        "OU_ID", "PERIOD", "INDICATOR", "VALUE")


@query("E19_active_year_on_rows", """
SELECT OU_ID, PERIOD, max(CASE WHEN CONF IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY OU_ID, YEAR) AS ACTIVE
FROM v_routine""")
def _(t):
    df = t.routine.withColumn("a", F.col("CONF").isNotNull().cast("int"))
    return S.max_back_on_rows(df, "a", ["OU_ID", "YEAR"], "ACTIVE").select("OU_ID", "PERIOD", "ACTIVE")


@query("E21_carry_forward", """
SELECT OU_ID, YEAR, MONTH, last_value(CONF IGNORE NULLS) OVER (PARTITION BY OU_ID, YEAR ORDER BY MONTH
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CONF FROM v_routine""")
def _(t):
    return S.carry_forward(t.routine.select("OU_ID", "YEAR", "MONTH", "CONF"), "OU_ID", "YEAR", "MONTH", "CONF")


@query("E22_cycles_long", """
SELECT ADM2_ID, YEAR, num_cycles, CAST(max(pct) AS INTEGER) AS max_pct_covered FROM (
  SELECT ADM2_ID, YEAR, 60 AS pct, CASE WHEN CONF > 40 THEN 3.0 WHEN CONF > 20 THEN 4.0 END AS num_cycles FROM v_routine
  UNION ALL
  SELECT ADM2_ID, YEAR, 80 AS pct, CASE WHEN CONF > 60 THEN 3.0 WHEN CONF > 30 THEN 5.0 END FROM v_routine)
WHERE num_cycles IS NOT NULL GROUP BY ALL""")
def _(t):
    c = F.col("CONF")
    df = t.routine.select("ADM2_ID", "YEAR", F.when(c > 40, 3.0).when(c > 20, 4.0).alias("CYCLES_60_PCT"),
                          F.when(c > 60, 3.0).when(c > 30, 5.0).alias("CYCLES_80_PCT"))
    return S.cycles_long(df, "ADM2_ID", "YEAR", ["CYCLES_60_PCT", "CYCLES_80_PCT"])


@query("E23_count_and_first_per_group", """
SELECT OU_ID, PERIOD, count(*) OVER (PARTITION BY OU_ID) AS n,
  first_value(SUSP) OVER (PARTITION BY OU_ID ORDER BY PERIOD) AS first_susp FROM v_routine""")
def _(t):
    return S.size_and_first(t.routine, ["OU_ID"], "PERIOD", "SUSP", "n", "first_susp").select("OU_ID", "PERIOD", "n", "first_susp")


# --- seasonality ------------------------------------------------------------------------------------


def _blocks_sql(value, total, share, extra=""):
    def ahead(n):
        return (f"CASE WHEN count(*) OVER (PARTITION BY ADM2_ID ORDER BY YEAR, MONTH ROWS BETWEEN CURRENT ROW AND "
                f"{n - 1} FOLLOWING) = {n} THEN coalesce(sum({value}) OVER (PARTITION BY ADM2_ID ORDER BY YEAR, MONTH "
                f"ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING), 0) END")
    sums = ", ".join(f"{ahead(n)} AS SUM_{n}M" for n in (3, 4, 5))
    denom = ahead(12) if total == "ahead" else f"coalesce(sum({value}) OVER (PARTITION BY ADM2_ID, YEAR), 0)"
    cols = ", ".join(
        f"SUM_{n}M, CASE WHEN TOTAL_12M > 0 THEN SUM_{n}M / TOTAL_12M END AS SHARE_{n}M, "
        f"CAST(TOTAL_12M > 0 AND CASE WHEN TOTAL_12M > 0 THEN SUM_{n}M / TOTAL_12M END >= {share} AS INTEGER) "
        f"AS FLAG_{n}M" for n in (3, 4, 5))
    return (f"SELECT ADM2_ID, YEAR, MONTH, {value} AS VALUE, TOTAL_12M, {cols} FROM ("
            f"SELECT *, {sums}, {denom} AS TOTAL_12M FROM v_district_month)")


VIEWS["v_blocks"] = _blocks_sql("RAIN", "ahead", 0.3)
VIEWS["v_season"] = """
SELECT ADM2_ID, max(CAST(p3 >= 0.5 AS INTEGER)) AS SEASONAL_3, max(CAST(p4 >= 0.5 AS INTEGER)) AS SEASONAL_4,
  max(CAST(p5 >= 0.5 AS INTEGER)) AS SEASONAL_5
FROM (SELECT ADM2_ID, MONTH,
  sum(FLAG_3M) / nullif(count(DISTINCT CASE WHEN FLAG_3M IS NOT NULL THEN YEAR END), 0) AS p3,
  sum(FLAG_4M) / nullif(count(DISTINCT CASE WHEN FLAG_4M IS NOT NULL THEN YEAR END), 0) AS p4,
  sum(FLAG_5M) / nullif(count(DISTINCT CASE WHEN FLAG_5M IS NOT NULL THEN YEAR END), 0) AS p5
  FROM v_blocks GROUP BY ALL) GROUP BY ALL
HAVING max(p3) IS NOT NULL AND max(p4) IS NOT NULL AND max(p5) IS NOT NULL"""
VIEWS["v_season_block"] = """
SELECT *, CASE WHEN SEASONAL_3 = 1 THEN 3 WHEN SEASONAL_4 = 1 THEN 4 WHEN SEASONAL_5 = 1 THEN 5 END AS BLOCK,
  CAST(SEASONAL_3 = 1 OR SEASONAL_4 = 1 OR SEASONAL_5 = 1 AS INTEGER) AS SEASONALITY FROM v_season"""
VIEWS["v_own_block"] = """
SELECT b.ADM2_ID, YEAR, MONTH, CASE BLOCK WHEN 3 THEN SUM_3M WHEN 4 THEN SUM_4M ELSE SUM_5M END AS block_sum,
  CASE BLOCK WHEN 3 THEN FLAG_3M WHEN 4 THEN FLAG_4M ELSE FLAG_5M END AS block_flag
FROM v_blocks b JOIN v_season_block s USING (ADM2_ID) WHERE BLOCK IS NOT NULL"""
VIEWS["v_share"] = """
SELECT ADM2_ID, avg(best / annual) AS PROPORTION FROM
  (SELECT ADM2_ID, YEAR, max(block_sum) AS best FROM v_own_block GROUP BY ALL) x
  JOIN (SELECT ADM2_ID, YEAR, sum(VALUE) AS annual FROM v_blocks GROUP BY ALL) y USING (ADM2_ID, YEAR)
WHERE best IS NOT NULL AND annual > 0 GROUP BY ALL"""
_MODE = """SELECT ADM2_ID, MONTH AS START_MONTH FROM (
  SELECT ADM2_ID, MONTH, row_number() OVER (PARTITION BY ADM2_ID ORDER BY count(*) DESC, MONTH) AS rk
  FROM {rows} GROUP BY ADM2_ID, MONTH) WHERE rk = 1"""
VIEWS["v_start"] = _MODE.format(rows="(SELECT * FROM v_own_block WHERE block_flag = 1)")
VIEWS["v_start_first"] = _MODE.format(
    rows="(SELECT ADM2_ID, YEAR, min(MONTH) AS MONTH FROM v_own_block WHERE block_flag = 1 GROUP BY ALL)")


def _rain(t):
    return t.district_month.select("ADM2_ID", "YEAR", "MONTH", F.col("RAIN").alias("VALUE"))


def _rain_blocks(t):
    return Z.month_blocks(_rain(t), "VALUE", threshold=0.3)


def _rain_districts(t):
    return Z.smallest_block(Z.seasonal_districts(_rain_blocks(t)))


@query("E9_E11_forward_blocks", "SELECT * FROM v_blocks", "SHARE_3M SHARE_4M SHARE_5M")
def _(t):
    return _rain_blocks(t)


@query("E10_calendar_year_blocks", _blocks_sql("RAIN", "year", 0.3), "SHARE_3M SHARE_4M SHARE_5M")
def _(t):
    return Z.month_blocks(_rain(t), "VALUE", threshold=0.3, calendar_year=True)


@query("E12_block_percentage", """
SELECT ADM2_ID, YEAR, MONTH, VALUE, TOTAL_YEAR, SUM_3M,
  CASE WHEN TOTAL_YEAR > 0 THEN SUM_3M * 100 / TOTAL_YEAR END AS PCT_3M,
  CAST(TOTAL_YEAR > 0 AND CASE WHEN TOTAL_YEAR > 0 THEN SUM_3M * 100 / TOTAL_YEAR END >= 30 AS INTEGER) AS REACHED_3M
FROM (SELECT ADM2_ID, YEAR, MONTH, RAIN AS VALUE, coalesce(sum(RAIN) OVER (PARTITION BY ADM2_ID, YEAR), 0) AS TOTAL_YEAR,
  CASE WHEN count(*) OVER f = 3 THEN coalesce(sum(RAIN) OVER f, 0) END AS SUM_3M FROM v_district_month
  WINDOW f AS (PARTITION BY ADM2_ID ORDER BY YEAR, MONTH ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))""", "PCT_3M")
def _(t):
    return Z.block_percentage(_rain(t), "VALUE", [3], 30)


@query("E13_seasonal_districts", "SELECT * FROM v_season")
def _(t):
    return Z.seasonal_districts(_rain_blocks(t))


@query("E14_smallest_block", "SELECT * FROM v_season_block")
def _(t):
    return _rain_districts(t)


@query("E15_season_share", "SELECT * FROM v_share", "PROPORTION")
def _(t):
    return Z.season_share(_rain_blocks(t), _rain_districts(t), "VALUE")


@query("E16_start_month_mode", "SELECT * FROM v_start")
def _(t):
    return Z.start_month(_rain_blocks(t), _rain_districts(t))


@query("E17_start_month_first_of_year", "SELECT * FROM v_start_first")
def _(t):
    return Z.start_month(_rain_blocks(t), _rain_districts(t), first_of_year=True)


@query("K18_case_seasonality", """
SELECT s.ADM2_ID, SEASONALITY AS SEASONALITY_CASES, CAST(BLOCK AS DOUBLE) AS SEASONAL_BLOCK_DURATION_CASES,
  CAST(START_MONTH AS DOUBLE) AS SEASONAL_BLOCK_START_MONTH_CASES, PROPORTION AS CASES_PROPORTION
FROM v_season_block s LEFT JOIN v_share USING (ADM2_ID) LEFT JOIN v_start USING (ADM2_ID)""", "CASES_PROPORTION")
def _(t):
    # months without a report are absent here, so no gap needs a model
    out = Z.seasonality(_rain(t), "VALUE", "CASES", "CASES_PROPORTION", threshold=0.3)
    return out.withColumns({c: F.col(c).cast("double") for c in
                            ("SEASONAL_BLOCK_DURATION_CASES", "SEASONAL_BLOCK_START_MONTH_CASES")})


@query("K19_rain_seasonality", """
SELECT s.ADM2_ID, SEASONALITY AS SEASONALITY_RAINFALL, CAST(BLOCK AS DOUBLE) AS SEASONAL_BLOCK_DURATION_RAINFALL,
  CAST(START_MONTH AS DOUBLE) AS SEASONAL_BLOCK_START_MONTH_RAINFALL, PROPORTION AS RAIN_PROPORTION
FROM v_season_block s LEFT JOIN v_share USING (ADM2_ID) LEFT JOIN v_start_first USING (ADM2_ID)""", "RAIN_PROPORTION")
def _(t):
    # every district counts here, as in the SQL: the guard asks for the months only, not for few missing ones
    months = _rain(t).withColumn("PERIOD", F.col("YEAR") * 100 + F.col("MONTH"))
    out = Z.rain_seasonality(months, "VALUE", threshold=0.3, max_missing=1.0, max_missing_unit=1.0)
    return out.withColumns({c: F.col(c).cast("double") for c in
                            ("SEASONAL_BLOCK_DURATION_RAINFALL", "SEASONAL_BLOCK_START_MONTH_RAINFALL")})


VIEWS["v_gaps"] = """
SELECT u.ADM2_ID, m.PERIOD, d.CASES FROM (SELECT DISTINCT ADM2_ID FROM v_routine) u CROSS JOIN (
  SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS PERIOD FROM (SELECT unnest(generate_series(
    (SELECT make_date(min(PERIOD) // 100, min(PERIOD) % 100, 1) FROM v_routine)::TIMESTAMP,
    (SELECT make_date(max(PERIOD) // 100, max(PERIOD) % 100, 1) FROM v_routine)::TIMESTAMP, INTERVAL 1 MONTH)) AS d)) m
LEFT JOIN (SELECT ADM2_ID, PERIOD, sum(ALLOUT) FILTER (WHERE PERIOD % 17 <> 5) AS CASES FROM v_routine GROUP BY ALL) d
  ON d.ADM2_ID = u.ADM2_ID AND d.PERIOD = m.PERIOD"""


def _gappy(t):
    """Outpatients as cases, with a month missing now and then."""
    return t.routine.withColumn("CASES", F.when(F.col("PERIOD") % 17 != 5, F.col("ALLOUT")))


@query("K18_case_seasonality_with_gaps_filled")
def _(t):
    return Z.case_seasonality(_gappy(t), "CASES")


@query("U2_fill_gaps")
def _(t):
    from ..operators.models import fill_gaps

    return fill_gaps(Z.district_months(_gappy(t), "CASES"), "CASES", "ESTIMATE")


@query("U2_fill_gaps_properties", """
SELECT ADM2_ID, count(*) AS n_months, count(*) - count(CASES) AS n_gaps, sum(CASES) AS known_sum, CAST(0 AS BIGINT) AS n_changed,
  CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_not_whole, CAST(0 AS BIGINT) AS n_negative FROM v_gaps GROUP BY 1""", "known_sum")
def _(t):
    """Known months keep their value; every gap gets a whole number that is not negative."""
    from ..operators.models import fill_gaps

    gap, e = F.col("CASES").isNull(), F.col("ESTIMATE")
    return fill_gaps(Z.district_months(_gappy(t), "CASES"), "CASES", "ESTIMATE").groupBy("ADM2_ID").agg(
        F.count(F.lit(1)).alias("n_months"), F.count_if(gap).alias("n_gaps"), F.sum(F.when(~gap, e)).alias("known_sum"),
        F.count_if(~gap & (e != F.col("CASES"))).alias("n_changed"), F.count_if(e.isNull() | F.isnan(e)).alias("n_missing"),
        F.count_if(gap & (e != F.floor(e))).alias("n_not_whole"), F.count_if(e < 0).alias("n_negative"))


@query("K18_readiness", """
SELECT max(months) AS n_months, sum(gone) / sum(n) AS missing_share, max(gone / n) AS worst_district_share,
  max(months) >= 36 AND sum(gone) / sum(n) <= 0.1 AND max(gone / n) <= 0.2 AS usable
FROM (SELECT a.ADM2_ID, count(*) AS n, count(DISTINCT m.PERIOD) AS months, count(*) - count(d.v) AS gone
  FROM (SELECT DISTINCT ADM2_ID FROM v_routine) a CROSS JOIN (SELECT DISTINCT PERIOD FROM v_routine) m
  LEFT JOIN (SELECT ADM2_ID, PERIOD, sum(MALDTH) AS v FROM v_routine GROUP BY ALL) d
    ON d.ADM2_ID = a.ADM2_ID AND d.PERIOD = m.PERIOD GROUP BY 1)""", "missing_share worst_district_share")
def _(t):
    return Z.readiness(Z.district_months(t.routine, "MALDTH"), "MALDTH", 36)
