"""Aggregations and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.binning import cut_half_open
from ..functions.nulls import sum_any, sum_poison, sum_zero
from ..operators import joins as J
from ..operators import keys as K
from ..operators import shape as H
from ..operators.quantiles import exact_quantiles
from ..plans import assemble as Z
from ..plans import formatting as Fm
from ..plans import incidence as I
from ..plans import outliers as O
from ..plans import population as Pop
from ..plans import quality as Q
from ..plans import reporting as R
from ..plans import reports as T
from .checks_join import indicator_map, monthly
from .registry import query
from .standins import INDICATORS, VIEWS

VIEWS["v_ind"] = """
SELECT OU, PE, INDICATOR, sum(try_cast(VALUE AS DOUBLE)) AS VALUE FROM v_matched GROUP BY ALL"""


@query("D1_build_indicators", "SELECT * FROM v_ind")
def _(t):
    return Fm.build_indicators(t.raw, indicator_map(t))


@query("D2_population_indicator", """
SELECT OU, PE, INDICATOR, coalesce(sum(trunc(try_cast(VALUE AS DOUBLE))), 0) AS VALUE FROM v_matched GROUP BY ALL""")
def _(t):
    from ..functions.nulls import truncate_int

    m = J.mapping_join(t.raw, indicator_map(t))
    return m.groupBy("OU", "PE", "INDICATOR").agg(sum_zero(truncate_int("VALUE")).alias("VALUE"))


@query("D3_monthly_district_cases", "SELECT ADM1_ID, ADM2_ID, YEAR, MONTH, CONF, TEST, SUSP, PRES FROM v_monthly")
def _(t):
    return monthly(t).select("ADM1_ID", "ADM2_ID", "YEAR", "MONTH", "CONF", "TEST", "SUSP", "PRES")


@query("D3_D4_three_kinds_of_sum", """
SELECT OU_ID, YEAR, coalesce(sum(MALDTH), 0) AS zero_sum,
  CASE WHEN count(*) = count(MALDTH) THEN sum(MALDTH) END AS poison_sum, sum(MALDTH) AS any_sum
FROM v_routine GROUP BY ALL""")
def _(t):
    return t.routine.groupBy("OU_ID", "YEAR").agg(
        sum_zero("MALDTH").alias("zero_sum"), sum_poison("MALDTH").alias("poison_sum"),
        sum_any("MALDTH").alias("any_sum"))


@query("D4_yearly_sums", """
SELECT ADM2_ID, YEAR, CASE WHEN count(*) = count(CONF) THEN sum(CONF) END AS CONF,
  CASE WHEN count(*) = count(N2) THEN sum(N2) END AS N2, coalesce(sum(N3), 0) AS N3 FROM v_n3 GROUP BY ALL""", "N2 N3")
def _(t):
    cases = I.with_care_seeking(monthly(t), I.care_seeking(t.care, "PCT"))
    return cases.groupBy("ADM2_ID", "YEAR").agg(
        sum_poison("CONF").alias("CONF"), sum_poison("N2").alias("N2"), sum_zero("N3").alias("N3"))


_QOC = ["TEST", "SUSP", "MALTREAT", "CONF", "MALDTH", "MALADM", "ALLADM", "ALLDTH", "ALLOUT", "PRES"]
VIEWS["v_qoc"] = ("SELECT ADM2_ID, YEAR, " + ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in _QOC)
                  + " FROM v_routine GROUP BY ALL")


@query("D5_district_year_sums", "SELECT * FROM v_qoc")
def _(t):
    return Q.district_year_sums(t.routine)


VIEWS["v_wide_reports"] = """
SELECT PERIOD, YEAR, MONTH, OU_ID, ADM2_ID, PRODUCT_UID,
  max(VALUE) FILTER (WHERE PRODUCT_METRIC = 'ACTUAL_REPORTS') AS ACTUAL_REPORTS,
  max(VALUE) FILTER (WHERE PRODUCT_METRIC = 'EXPECTED_REPORTS') AS EXPECTED_REPORTS
FROM v_reports WHERE PRODUCT_UID IN ('F', 'O') GROUP BY ALL"""
VIEWS["v_dedup_reports"] = """
SELECT * EXCLUDE (best) FROM (SELECT *, max(ACTUAL_REPORTS) OVER (PARTITION BY OU_ID, PERIOD) AS best FROM v_wide_reports)
WHERE OU_ID NOT IN (SELECT OU_ID FROM v_wide_reports GROUP BY OU_ID, PERIOD HAVING count(*) > 1) OR ACTUAL_REPORTS = best"""
VIEWS["v_dataset_rate"] = """
SELECT PERIOD, YEAR, MONTH, ADM2_ID, sum(ACTUAL_REPORTS) AS ACTUAL_REPORTS, sum(EXPECTED_REPORTS) AS EXPECTED_REPORTS,
  sum(ACTUAL_REPORTS) / nullif(sum(EXPECTED_REPORTS), 0) AS REPORTING_RATE FROM v_dedup_reports GROUP BY ALL"""


@query("D6_reports_and_rate", """
SELECT PERIOD, ADM2_ID, sum(ACTUAL_REPORTS) AS ACTUAL_REPORTS, sum(EXPECTED_REPORTS) AS EXPECTED_REPORTS,
  sum(ACTUAL_REPORTS) / nullif(sum(EXPECTED_REPORTS), 0) AS REPORTING_RATE FROM v_wide_reports GROUP BY ALL""",
       "REPORTING_RATE")
def _(t):
    return R.district_rate(R.reports_wide(R.chosen_products(t.reports, ["F", "O"])), ["PERIOD", "ADM2_ID"])


@query("D20_pivot_reports", "SELECT * FROM v_wide_reports")
def _(t):
    return R.reports_wide(R.chosen_products(t.reports, ["F", "O"]))


@query("E20_deduplicate_reports", "SELECT * FROM v_dedup_reports")
def _(t):
    return R.deduplicate_reports(R.reports_wide(R.chosen_products(t.reports, ["F", "O"])))


@query("K12_dataset_reporting_rate", "SELECT * FROM v_dataset_rate", "REPORTING_RATE")
def _(t):
    return R.dataset_rate(t.reports, ["F", "O"])


@query("K12_dataset_rate_on_routine", """
SELECT r.OU_ID, r.PERIOD, d.REPORTING_RATE FROM v_routine r LEFT JOIN v_dataset_rate d USING (ADM2_ID, YEAR, MONTH)""",
       "REPORTING_RATE")
def _(t):
    return R.attach_rate(t.routine, R.dataset_rate(t.reports, ["F", "O"])).select("OU_ID", "PERIOD", "REPORTING_RATE")


@query("B6_unknown_product_keeps_all", "SELECT PERIOD, OU_ID, PRODUCT_UID, PRODUCT_METRIC, VALUE FROM v_reports")
def _(t):
    return R.chosen_products(t.reports, ["F", "not there"]).select(
        "PERIOD", "OU_ID", "PRODUCT_UID", "PRODUCT_METRIC", "VALUE")


@query("D54_units_in_several_products", """
SELECT OU_ID, count(DISTINCT PRODUCT_UID) AS n_products FROM v_reports GROUP BY 1 HAVING count(DISTINCT PRODUCT_UID) > 1""")
def _(t):
    return R.units_in_several_products(t.reports)


# --- data element reporting rate --------------------------------------------------------------------

VIEWS["v_months"] = """
SELECT p.ADM1_ID, p.ADM1_NAME, p.ADM2_ID, p.ADM2_NAME, p.OU_ID, m.PERIOD, CAST(m.PERIOD // 100 AS INTEGER) AS YEAR,
  coalesce(f.a, 0) AS ACTIVE_THIS_PERIOD,
  CAST(coalesce(OPENING_DATE <= d AND (CLOSED_DATE IS NULL OR CLOSED_DATE > d), false)
    AND NOT regexp_matches(upper(OU_NAME), 'CLOTUR|FERM(E|EE)?') AS INTEGER) AS OPEN
FROM v_pyramid p CROSS JOIN (SELECT DISTINCT PERIOD, make_date(PERIOD // 100, PERIOD % 100, 1) AS d FROM v_facts) m
LEFT JOIN (SELECT OU_ID, PERIOD, max(CAST(coalesce(CONF >= 0, false) OR coalesce(MALDTH >= 0, false) AS INTEGER)) AS a
           FROM v_facts GROUP BY 1, 2) f ON f.OU_ID = p.OU_ID AND f.PERIOD = m.PERIOD"""
VIEWS["v_months_year"] = """
SELECT *, max(ACTIVE_THIS_PERIOD) OVER (PARTITION BY OU_ID, YEAR) AS ACTIVE_THIS_YEAR FROM v_months"""
VIEWS["v_means"] = """
SELECT ADM2_ID, OU_ID, sum(t) / nullif(count(*) FILTER (WHERE t > 0), 0) AS MEAN_CASES
FROM (SELECT ADM2_ID, OU_ID, coalesce(CONF, 0) + coalesce(MALDTH, 0) AS t FROM v_routine) GROUP BY 1, 2"""
VIEWS["v_weights"] = """
SELECT ADM2_ID, OU_ID, MEAN_CASES, MEAN_CASES / nullif(s, 0) * hf AS WEIGHT FROM v_means JOIN
  (SELECT ADM2_ID, coalesce(sum(MEAN_CASES), 0) AS s, count(*) AS hf FROM v_means GROUP BY 1) USING (ADM2_ID)"""
VIEWS["v_rates"] = """
SELECT *, ACTIVE_THIS_PERIOD / nullif(COUNT, 0) AS RR_TOTAL_HF, ACTIVE_THIS_PERIOD / nullif(OPEN, 0) AS RR_OPEN_HF,
  ACTIVE_THIS_PERIOD / nullif(ACTIVE_THIS_YEAR, 0) AS RR_ACTIVE_HF,
  ACTIVE_THIS_PERIOD_W / nullif(COUNT_W, 0) AS RR_TOTAL_HF_W, ACTIVE_THIS_PERIOD_W / nullif(OPEN_W, 0) AS RR_OPEN_HF_W,
  ACTIVE_THIS_PERIOD_W / nullif(ACTIVE_THIS_YEAR_W, 0) AS RR_ACTIVE_HF_W
FROM (SELECT ADM1_ID, ADM1_NAME, m.ADM2_ID, ADM2_NAME, YEAR, PERIOD,
  CAST(sum(ACTIVE_THIS_PERIOD) AS DOUBLE) AS ACTIVE_THIS_PERIOD, CAST(count(*) AS DOUBLE) AS COUNT,
  CAST(sum(OPEN) AS DOUBLE) AS OPEN, CAST(sum(ACTIVE_THIS_YEAR) AS DOUBLE) AS ACTIVE_THIS_YEAR,
  coalesce(sum(ACTIVE_THIS_PERIOD * WEIGHT), 0) AS ACTIVE_THIS_PERIOD_W, coalesce(sum(WEIGHT), 0) AS COUNT_W,
  coalesce(sum(OPEN * WEIGHT), 0) AS OPEN_W, coalesce(sum(ACTIVE_THIS_YEAR * WEIGHT), 0) AS ACTIVE_THIS_YEAR_W
  FROM v_months_year m LEFT JOIN (SELECT OU_ID, WEIGHT FROM v_weights) w ON w.OU_ID = m.OU_ID GROUP BY ALL)"""
ACTIVITY = ["CONF", "MALDTH"]
RATE_COLS = " ".join(f"RR_{d}_HF{w}" for d in ("TOTAL", "OPEN", "ACTIVE") for w in ("", "_W"))
SUM_COLS = "ACTIVE_THIS_PERIOD_W COUNT_W OPEN_W ACTIVE_THIS_YEAR_W"


def _months(t, weighted=False):
    weights = R.facility_weights(t.routine, ACTIVITY).select("OU_ID", "WEIGHT") if weighted else None
    return R.facility_months(t.pyramid, t.routine, ACTIVITY, weights)


@query("B9_B10_open_and_active_flags", "SELECT OU_ID, PERIOD, ACTIVE_THIS_PERIOD, OPEN FROM v_months")
def _(t):
    return R.facility_months(t.pyramid, t.routine, ACTIVITY).select("OU_ID", "PERIOD", "ACTIVE_THIS_PERIOD", "OPEN")


@query("B11_older_active_flag", """
SELECT OU_ID, PERIOD, CONF IS NOT NULL OR MALDTH IS NOT NULL AS ACTIVE FROM v_routine""")
def _(t):
    from ..functions.nulls import any_true

    return t.routine.select("OU_ID", "PERIOD", any_true([F.col(c).isNotNull() for c in ACTIVITY]).alias("ACTIVE"))


@query("D7_yearly_facility_counts", """
SELECT *, HF_ACTIVE / nullif(NR_OF_HF, 0) AS RR_TOTAL_HF, HF_ACTIVE / nullif(NR_OF_OPEN_HF, 0) AS RR_OPEN_HF FROM (
  SELECT ADM1_ID, ADM1_NAME, ADM2_ID, ADM2_NAME, YEAR, count(*) AS NR_OF_HF, CAST(sum(o) AS BIGINT) AS NR_OF_OPEN_HF,
    CAST(sum(a) AS BIGINT) AS HF_ACTIVE FROM (SELECT ADM1_ID, ADM1_NAME, ADM2_ID, ADM2_NAME, OU_ID, YEAR, max(OPEN) AS o,
      max(ACTIVE_THIS_YEAR) AS a FROM v_months_year GROUP BY ALL) GROUP BY ALL)""", "RR_TOTAL_HF RR_OPEN_HF")
def _(t):
    return R.yearly_rates(_months(t))


@query("D8_facility_means", "SELECT * FROM v_means", "MEAN_CASES")
def _(t):
    return R.facility_means(t.routine, ACTIVITY)


@query("D9_facility_weights", "SELECT * FROM v_weights", "MEAN_CASES WEIGHT")
def _(t):
    return R.facility_weights(t.routine, ACTIVITY)


@query("D10_all_reporting_rates", "SELECT * FROM v_rates", f"{RATE_COLS} {SUM_COLS}")
def _(t):
    return R.monthly_rates(_months(t, weighted=True))


for _col, _den, _w in (("RR_ACTIVE_HF", "ROUTINE_ACTIVE_FACILITIES", False),
                       ("RR_OPEN_HF_W", "PYRAMID_OPEN_FACILITIES", True)):
    query(f"K13_element_rate_{_col.lower()}", f"""
SELECT ADM2_ID, YEAR, CAST(PERIOD % 100 AS INTEGER) AS MONTH, {_col} AS REPORTING_RATE FROM v_rates""",
          "REPORTING_RATE")(lambda t, d=_den, w=_w: R.element_rate(t.pyramid, t.staged_routine, ACTIVITY, ACTIVITY, d, w))


@query("B17_chosen_rate", """
SELECT ADM2_ID, YEAR, CAST(PERIOD % 100 AS INTEGER) AS MONTH, RR_ACTIVE_HF_W AS REPORTING_RATE FROM v_rates""",
       "REPORTING_RATE")
def _(t):
    return R.chosen_rate(R.monthly_rates(_months(t, weighted=True)), "ROUTINE_ACTIVE_FACILITIES", weighted=True)


VIEWS["v_submitted"] = """
SELECT ADM2_ID, YEAR, MONTH, sum(CAST(CONF IS NOT NULL OR MALDTH IS NOT NULL AS INTEGER)) AS n FROM v_routine GROUP BY ALL"""


@query("D11_K14_rate_by_yearly_facilities", """
SELECT s.ADM2_ID, s.YEAR, s.MONTH, CAST(s.n AS BIGINT) AS SUBMITTED_REPORTS, e.EXPECTED_REPORTS,
  s.n / nullif(e.EXPECTED_REPORTS, 0) AS REPORTING_RATE FROM v_submitted s LEFT JOIN (
  SELECT ADM2_ID, YEAR, count(DISTINCT OU_ID) AS EXPECTED_REPORTS FROM v_routine
  WHERE CONF IS NOT NULL OR MALDTH IS NOT NULL GROUP BY ALL) e USING (ADM2_ID, YEAR)""", "REPORTING_RATE")
def _(t):
    return R.older_rate(t.routine, ACTIVITY, R.expected_from_routine(t.routine, ACTIVITY))


@query("K14_rate_by_open_facilities", """
SELECT s.ADM2_ID, s.YEAR, s.MONTH, CAST(s.n AS BIGINT) AS SUBMITTED_REPORTS,
  coalesce(e.n, CASE WHEN s.ADM2_ID IN (SELECT ADM2_ID FROM v_pyramid) THEN 0 END) AS EXPECTED_REPORTS,
  s.n / nullif(e.n, 0) AS REPORTING_RATE
FROM v_submitted s LEFT JOIN (SELECT p.ADM2_ID, m.PERIOD // 100 AS YEAR, m.PERIOD % 100 AS MONTH, count(*) AS n
  FROM v_pyramid p JOIN (SELECT DISTINCT PERIOD, make_date(PERIOD // 100, PERIOD % 100, 1) AS d FROM v_routine) m
    ON p.OPENING_DATE <= last_day(d) AND (p.CLOSED_DATE IS NULL OR p.CLOSED_DATE >= d) GROUP BY ALL) e
  ON e.ADM2_ID = s.ADM2_ID AND e.YEAR = s.YEAR AND e.MONTH = s.MONTH""", "REPORTING_RATE")
def _(t):
    return R.older_rate(t.routine, ACTIVITY, R.expected_from_pyramid(t.pyramid, t.routine))


@query("K14_rate_by_dataset_expected", """
SELECT s.ADM2_ID, s.YEAR, s.MONTH, CAST(s.n AS BIGINT) AS SUBMITTED_REPORTS, d.EXPECTED_REPORTS,
  s.n / nullif(d.EXPECTED_REPORTS, 0) AS REPORTING_RATE FROM v_submitted s
LEFT JOIN v_dataset_rate d USING (ADM2_ID, YEAR, MONTH)""", "REPORTING_RATE")
def _(t):
    expected = R.dataset_rate(t.reports, ["F", "O"]).select("ADM2_ID", "YEAR", "MONTH", "EXPECTED_REPORTS")
    return R.older_rate(t.routine, ACTIVITY, expected)


# --- summaries for the results table ----------------------------------------------------------------


@query("D12_mean_rate", "SELECT ADM2_ID, round_even(avg(REPORTING_RATE) * 100, 1) AS REPORTING_RATE FROM v_rate GROUP BY 1")
def _(t):
    return Z.mean_rate(t.rate)


@query("D12_median_rate", """
SELECT ADM2_ID, round_even(median(REPORTING_RATE) * 100, 1) AS REPORTING_RATE FROM v_rate GROUP BY 1""")
def _(t):
    return Z.mean_rate(t.rate, "median")


@query("D13_B12_median_over_last_years", """
SELECT ADM2_ID, median(CONF) AS INCIDENCE_CRUDE FROM v_district_month
WHERE YEAR > (SELECT max(YEAR) - 3 FROM v_district_month) GROUP BY 1""", "INCIDENCE_CRUDE")
def _(t):
    df = t.district_month.select("ADM2_ID", "YEAR", F.col("CONF").alias("INCIDENCE_CRUDE"))
    return Z.mean_incidence(df, "median", -3)


# --- shape ------------------------------------------------------------------------------------------


@query("D20_pivot_indicators", """
SELECT OU_ID, PERIOD, SUSP, TEST, CONF, PRES FROM v_routine""")
def _(t):
    return H.wide_form(t.long, ["OU_ID", "PERIOD"], INDICATORS)


@query("D21_unpivot", "SELECT OU_ID, PERIOD, INDICATOR, VALUE FROM v_long")
def _(t):
    return H.long_form(t.routine, ["OU_ID", "PERIOD"], INDICATORS)


@query("D32_period_range_and_latest", """
SELECT ADM2_ID, min(PERIOD) AS lo, max(PERIOD) AS hi, max_by(coalesce(CONF, -1), PERIOD) AS latest FROM v_district_month GROUP BY 1""")
def _(t):
    return K.range_and_latest(t.district_month, ["ADM2_ID"], "PERIOD", "CONF", -1.0)


@query("D33_complete_groups", """
SELECT ADM2_ID, YEAR, MONTH FROM v_district_month WHERE YEAR IN (SELECT YEAR FROM v_district_month GROUP BY 1
  HAVING count(DISTINCT MONTH) = (SELECT count(DISTINCT MONTH) FROM v_district_month))""")
def _(t):
    return K.complete_groups(t.district_month.select("ADM2_ID", "YEAR", "MONTH"), "YEAR", "MONTH")


@query("D34_top_summed_group", """
SELECT MONTH, v AS top_value, count(*) OVER () AS n_top FROM (SELECT MONTH, sum(CONF) AS v FROM v_district_month GROUP BY 1)
WHERE v = (SELECT max(v) FROM (SELECT sum(CONF) AS v FROM v_district_month GROUP BY MONTH))""")
def _(t):
    return K.top_summed_groups(t.district_month, "CONF", "MONTH")


VIEWS["v_zero_rate"] = """
SELECT ADM2_ID, YEAR, MONTH, CASE WHEN REPORTING_RATE = 1 THEN 0.0 WHEN REPORTING_RATE < 0.9 THEN NULL ELSE REPORTING_RATE END
  AS REPORTING_RATE FROM v_rate"""


def _zero_rate(t):
    r = F.col("REPORTING_RATE")
    return t.rate.withColumn("REPORTING_RATE", F.when(r == 1, 0.0).when(r >= 0.9, r))


@query("D35_zero_rate_counts", """
SELECT count(*) AS zero_months, count(DISTINCT ADM2_ID) AS zero_districts FROM v_zero_rate WHERE REPORTING_RATE = 0""")
def _(t):
    return I.zero_rates(_zero_rate(t))


@query("D35_missing_rate_share", """
SELECT YEAR, (count(*) - count(REPORTING_RATE)) / count(*) * 100 AS pct_missing FROM v_zero_rate GROUP BY 1""", "pct_missing")
def _(t):
    return I.missing_rate_share(_zero_rate(t))


# --- completeness -----------------------------------------------------------------------------------

VIEWS["v_zlong"] = """
SELECT * REPLACE (CASE WHEN VALUE < 40 THEN 0.0 WHEN VALUE < 200 THEN VALUE END AS VALUE) FROM v_long"""


def _zlong(t):
    v = F.col("VALUE")
    return t.long.withColumn("VALUE", F.when(v < 40, 0.0).when(v < 200, v))


@query("D36_value_status", """
SELECT g.INDICATOR, g.PERIOD, count(*) AS n_total, count(*) - count(l.VALUE) AS n_missing,
  count(*) FILTER (WHERE l.VALUE = 0) AS n_zero, count(*) FILTER (WHERE l.VALUE > 0) AS n_positive,
  (count(*) - count(l.VALUE)) / count(*) * 100 AS pct_missing, count(*) FILTER (WHERE l.VALUE = 0) / count(*) * 100 AS pct_zero,
  count(*) FILTER (WHERE l.VALUE > 0) / count(*) * 100 AS pct_positive
FROM (SELECT * FROM (SELECT DISTINCT OU_ID FROM v_zlong) CROSS JOIN (SELECT DISTINCT PERIOD FROM v_zlong)
      CROSS JOIN (SELECT DISTINCT INDICATOR FROM v_zlong)) g
LEFT JOIN v_zlong l ON l.OU_ID = g.OU_ID AND l.PERIOD = g.PERIOD AND l.INDICATOR = g.INDICATOR GROUP BY 1, 2""",
       "pct_missing pct_zero pct_positive")
def _(t):
    return T.value_status(_zlong(t))


@query("D36_district_status", """
SELECT g.INDICATOR, g.PERIOD, count(*) AS n_total, count(*) FILTER (WHERE coalesce(n, 0) = 0) AS n_missing,
  count(*) FILTER (WHERE n > 0 AND zero) AS n_zero, count(*) FILTER (WHERE top > 0) AS n_positive,
  100 * count(*) FILTER (WHERE coalesce(n, 0) = 0) / count(*) AS pct_missing, 100 * count(*) FILTER (WHERE n > 0 AND zero) / count(*) AS pct_zero,
  100 * count(*) FILTER (WHERE top > 0) / count(*) AS pct_positive
FROM (SELECT * FROM (SELECT DISTINCT ADM2_ID FROM v_zlong) CROSS JOIN (SELECT DISTINCT PERIOD FROM v_zlong)
      CROSS JOIN (SELECT DISTINCT INDICATOR FROM v_zlong)) g
LEFT JOIN (SELECT INDICATOR, PERIOD, ADM2_ID, count(VALUE) AS n, max(VALUE) AS top, bool_and(VALUE = 0) AS zero FROM v_zlong GROUP BY ALL) l
  ON l.ADM2_ID = g.ADM2_ID AND l.PERIOD = g.PERIOD AND l.INDICATOR = g.INDICATOR GROUP BY 1, 2""", "pct_missing pct_zero pct_positive")
def _(t):
    return T.district_status(_zlong(t))


@query("D37_monthly_reporting", """
WITH p AS (SELECT OU_ID, YEAR, PERIOD, bool_or(MALDTH IS NOT NULL) AS a FROM v_routine GROUP BY ALL)
SELECT YEAR, PERIOD, n_reporting, n_active_year, n_active_ever, 100 * n_reporting / n_active_ever AS pct_of_ever,
  100 * n_reporting / nullif(n_active_year, 0) AS pct_of_year
FROM (SELECT YEAR, PERIOD, count(*) FILTER (WHERE a) AS n_reporting FROM p GROUP BY ALL)
JOIN (SELECT YEAR, count(DISTINCT OU_ID) FILTER (WHERE a) AS n_active_year FROM p GROUP BY 1) USING (YEAR)
CROSS JOIN (SELECT count(DISTINCT OU_ID) FILTER (WHERE a) AS n_active_ever FROM p)""", "pct_of_ever pct_of_year")
def _(t):
    return T.monthly_reporting(t.routine, ["MALDTH"])


@query("D37_yearly_activity", """
SELECT YEAR, count(*) FILTER (WHERE a) AS n_active, count(*) AS n_listed,
  count(*) FILTER (WHERE a) / (SELECT count(DISTINCT OU_ID) FROM v_routine) * 100 AS pct_of_all,
  count(*) FILTER (WHERE a) / count(*) * 100 AS pct_of_listed
FROM (SELECT OU_ID, YEAR, bool_or(MALDTH IS NOT NULL) AS a FROM v_routine GROUP BY ALL) GROUP BY 1""", "pct_of_all pct_of_listed")
def _(t):
    return T.facility_activity(t.routine, ["MALDTH"])


@query("D37_ever_active", """
SELECT count(*) FILTER (WHERE a) AS n_active, count(*) AS n_facilities, count(*) FILTER (WHERE a) / count(*) * 100 AS pct_active
FROM (SELECT OU_ID, bool_or(MALDTH > 60) AS a FROM v_routine GROUP BY 1)""", "pct_active")
def _(t):
    return T.ever_active(t.routine.withColumn("x", F.when(F.col("MALDTH") > 60, 1)), ["x"])


@query("D37_monthly_activity", """
SELECT PERIOD, count(DISTINCT OU_ID) AS n_active FROM v_routine WHERE MALDTH IS NOT NULL GROUP BY 1""")
def _(t):
    return T.monthly_activity(t.routine, ["MALDTH"])


@query("D38_opened_and_reporting", """
SELECT y.YEAR, y.n_open, coalesce(r.n_reporting, 0) AS n_reporting, coalesce(r.n_reporting, 0) / nullif(y.n_open, 0) * 100 AS pct_reporting
FROM (SELECT y.YEAR, count(p.OU_ID) AS n_open FROM (SELECT DISTINCT YEAR FROM v_routine) y LEFT JOIN v_pyramid p
  ON OPENING_DATE <= make_date(y.YEAR, 12, 31) AND (CLOSED_DATE IS NULL OR CLOSED_DATE >= make_date(y.YEAR, 1, 1)) GROUP BY 1) y
LEFT JOIN (SELECT YEAR, count(DISTINCT OU_ID) AS n_reporting FROM v_routine WHERE MALDTH IS NOT NULL GROUP BY 1) r USING (YEAR)""",
       "pct_reporting")
def _(t):
    return T.opened_and_reporting(t.pyramid, t.routine, ["MALDTH"])


@query("D39_element_coverage", """
SELECT OU, DX, n_months, coverage, avg(coverage) OVER (PARTITION BY OU) AS unit_coverage FROM (
  SELECT OU, DX, count(DISTINCT PE) FILTER (WHERE v IS NOT NULL) AS n_months,
    count(DISTINCT PE) FILTER (WHERE v IS NOT NULL) / (SELECT count(DISTINCT PE) FROM v_raw) AS coverage
  FROM (SELECT *, CASE WHEN NOT (DX = 'N' AND ends_with(OU, '1')) THEN VALUE END AS v FROM v_raw) GROUP BY 1, 2)""", "coverage unit_coverage")
def _(t):
    # some facilities list an element without any value
    listed = (F.col("DX") == "N") & F.endswith("OU", F.lit("1"))
    return T.element_coverage(t.raw.withColumn("VALUE", F.when(~listed, F.col("VALUE"))))


_PREFIX = "CASE CAST(floor(abs(s_acctbal)) AS BIGINT) % 6 WHEN 0 THEN 'CSI ' WHEN 1 THEN 'HD ' WHEN 2 THEN 'salle  ' WHEN 3 THEN 'CABINET ' WHEN 4 THEN 'CS' ELSE 'POLYCLINIQUE ' END || s_suppkey"
VIEWS["v_typed"] = f"""
SELECT 'F' || s_suppkey AS OU_ID, {_PREFIX} AS OU_NAME, CASE CAST(floor(abs(s_acctbal)) AS BIGINT) % 6
  WHEN 0 THEN 'CSI (centre de santé intégré)' WHEN 1 THEN 'HD (hôpital de district)' WHEN 2 THEN 'SS / Salle (soins/maternité)'
  WHEN 3 THEN 'Cabinet (privé)' WHEN 4 THEN 'Autre' ELSE 'Clinique (privé)' END AS type
FROM supplier"""


def named_facilities(t):
    """Facility names with type prefixes, by account balance."""
    s = t.raw_table("supplier")
    k = F.floor(F.abs("s_acctbal")) % 6
    prefix = (F.when(k == 0, "CSI ").when(k == 1, "HD ").when(k == 2, "salle  ").when(k == 3, "CABINET ").when(k == 4, "CS")
              .otherwise("POLYCLINIQUE "))
    return s.select(F.concat(F.lit("F"), "s_suppkey").alias("OU_ID"), F.concat(prefix, "s_suppkey").alias("OU_NAME"))


@query("D40_types_with_total", """
SELECT type, count(*) AS n FROM v_typed GROUP BY 1 UNION ALL SELECT 'Total', count(*) FROM v_typed""")
def _(t):
    return T.types_with_total(named_facilities(t))


@query("D41_units_per_level", """
SELECT 'ADM1_ID' AS level, count(DISTINCT ADM1_ID) AS n_units, 'region' AS role FROM v_pyramid
UNION ALL SELECT 'ADM2_ID', count(DISTINCT ADM2_ID), 'district' FROM v_pyramid
UNION ALL SELECT 'OU_ID', count(DISTINCT OU_ID), 'facility' FROM v_pyramid""")
def _(t):
    return T.units_per_level(t.pyramid, {"ADM1_ID": "region", "ADM2_ID": "district", "OU_ID": "facility"})


@query("D42_categories_per_element", """
SELECT DX, string_agg(DISTINCT CO, '; ' ORDER BY CO) AS categories FROM v_raw GROUP BY 1""")
def _(t):
    return T.categories_per_element(t.raw)


_PAIRS = {n: (a, b, text) for n, (a, b, text) in T.COHERENCE.items()}
_NATIONAL = " UNION ALL ".join(
    f"SELECT YEAR, '{n}' AS check_type, avg(CAST({a} >= {b} AS INTEGER)) * 100 AS pct_coherent, '{x}' AS check_label "
    f"FROM v_routine GROUP BY YEAR HAVING count({a} >= {b}) > 0" for n, (a, b, x) in _PAIRS.items())
_DISTRICT = " UNION ALL ".join(
    f"SELECT ADM1_NAME, ADM2_NAME, ADM2_ID, YEAR, count(*) AS total_reports, 'pct_coherent_{n}' AS check_type, "
    f"avg(CAST({a} >= {b} AS INTEGER)) * 100 AS pct_coherent, '{x}' AS check_label FROM v_routine GROUP BY ALL HAVING count(*) >= 20"
    for n, (a, b, x) in _PAIRS.items())


@query("D43_national_coherence", _NATIONAL, "pct_coherent")
def _(t):
    return T.national_coherence(t.routine)


@query("D43_district_coherence", f"SELECT * FROM ({_DISTRICT}) WHERE pct_coherent IS NOT NULL", "pct_coherent")
def _(t):
    return T.district_coherence(t.routine, 20)


@query("D44_scatter_statistics", """
SELECT count(*) AS n_points, round_even(100 * count(*) FILTER (WHERE CONF > TEST) / count(*), 2) AS pct_above, max(q) AS "limit",
  round_even(100 * count(*) FILTER (WHERE TEST > q OR CONF > q) / count(*), 3) AS pct_beyond
FROM v_routine, (SELECT quantile_cont(v, 0.999) AS q FROM (SELECT TEST AS v FROM v_routine UNION ALL SELECT CONF FROM v_routine))""", "pct_above limit pct_beyond")
def _(t):
    return T.scatter_stats(t.routine, "TEST", "CONF")


VIEWS["v_yearly"] = """
SELECT n.ADM2_ID, n.YEAR, n.CONF, n.N1, n.N2, n.N3, p.POPULATION, p.ADM1_NAME, p.ADM2_NAME, p.POP_UNDER_5,
  n.CONF / nullif(p.POPULATION, 0) * 1000 AS INCIDENCE_CRUDE, n.N1 / nullif(p.POPULATION, 0) * 1000 AS INCIDENCE_ADJ_TESTING,
  n.N2 / nullif(p.POPULATION, 0) * 1000 AS INCIDENCE_ADJ_REPORTING, n.N3 / nullif(p.POPULATION, 0) * 1000 AS INCIDENCE_ADJ_CARESEEKING
FROM (SELECT ADM2_ID, YEAR, sum(CONF) AS CONF, sum(N1) AS N1, CASE WHEN count(*) = count(N2) THEN sum(N2) END AS N2,
        coalesce(sum(N3), 0) AS N3 FROM v_n3 GROUP BY ALL) n
LEFT JOIN v_population p USING (ADM2_ID, YEAR)"""
Y_COLS = "N1 N2 N3 INCIDENCE_CRUDE INCIDENCE_ADJ_TESTING INCIDENCE_ADJ_REPORTING INCIDENCE_ADJ_CARESEEKING"


def yearly(t):
    t.use_staged_routine()
    return I.incidence(t.routine, t.rate, t.population, "PRES", I.care_seeking(t.care, "PCT"))


@query("D45_yearly_order_checks", """
SELECT count(*) FILTER (WHERE INCIDENCE_ADJ_TESTING < INCIDENCE_CRUDE) AS INCIDENCE_ADJ_TESTING_below_INCIDENCE_CRUDE,
  count(*) FILTER (WHERE INCIDENCE_ADJ_REPORTING < INCIDENCE_ADJ_TESTING) AS INCIDENCE_ADJ_REPORTING_below_INCIDENCE_ADJ_TESTING,
  count(*) FILTER (WHERE INCIDENCE_ADJ_CARESEEKING < INCIDENCE_ADJ_REPORTING) AS INCIDENCE_ADJ_CARESEEKING_below_INCIDENCE_ADJ_REPORTING
FROM v_yearly""")
def _(t):
    return I.yearly_order_checks(yearly(t))


@query("D45_monthly_checks", """
SELECT count(*) FILTER (WHERE CONF > TEST) AS conf_above_test, count(*) FILTER (WHERE SUSP < TEST) AS susp_below_test,
  count(*) FILTER (WHERE PRES = 0) AS pres_zero, count(*) FILTER (WHERE CONF > N1) AS conf_above_n1,
  count(*) FILTER (WHERE N1 > N2) AS n1_above_n2 FROM v_n2""")
def _(t):
    return I.monthly_checks(monthly(t))


@query("D46_yearly_positivity", """
SELECT ADM2_ID, YEAR, CONF, TEST, CASE WHEN TEST != 0 THEN CONF / TEST ELSE 1.0 END AS TPR FROM (
  SELECT ADM2_ID, YEAR, sum(CONF) AS CONF, sum(TEST) AS TEST FROM v_monthly GROUP BY ALL)""", "TPR")
def _(t):
    return I.yearly_positivity(monthly(t))


@query("D47_mean_incidence", """
SELECT ADM2_ID, avg(INCIDENCE_CRUDE) AS INCIDENCE_CRUDE, avg(INCIDENCE_ADJ_TESTING) AS INCIDENCE_ADJ_TESTING,
  avg(INCIDENCE_ADJ_REPORTING) AS INCIDENCE_ADJ_REPORTING, avg(INCIDENCE_ADJ_CARESEEKING) AS INCIDENCE_ADJ_CARESEEKING
FROM v_yearly GROUP BY 1""", "INCIDENCE_CRUDE INCIDENCE_ADJ_TESTING INCIDENCE_ADJ_REPORTING INCIDENCE_ADJ_CARESEEKING")
def _(t):
    return Z.mean_incidence(yearly(t))


VIEWS["v_quality"] = """
SELECT *, CASE WHEN SUSP > 0 THEN TEST / SUSP END AS testing_rate, CASE WHEN CONF > 0 THEN MALTREAT / CONF END AS treatment_rate,
  CASE WHEN MALADM > 0 THEN MALDTH / MALADM END AS case_fatality_rate, CASE WHEN ALLADM > 0 THEN MALADM / ALLADM END AS prop_adm_malaria,
  CASE WHEN ALLDTH > 0 THEN MALDTH / ALLDTH END AS prop_malaria_deaths, ALLOUT AS non_malaria_all_cause_outpatients,
  PRES AS presumed_cases FROM v_qoc"""
Q_COLS = "testing_rate treatment_rate case_fatality_rate prop_adm_malaria prop_malaria_deaths"


@query("H30_quality_ratios", f"SELECT ADM2_ID, YEAR, {', '.join(Q_COLS.split())} FROM v_quality", Q_COLS)
def _(t):
    return Q.quality_of_care(t.routine).select("ADM2_ID", "YEAR", *Q_COLS.split())


@query("K17_quality_of_care", "SELECT q.*, a.ADM1_NAME, a.ADM2_NAME FROM v_quality q LEFT JOIN v_admin a USING (ADM2_ID)", Q_COLS)
def _(t):
    return Q.quality_of_care(t.routine, t.admin.select("ADM2_ID", "ADM1_NAME", "ADM2_NAME"))


@query("D48_national_quality_summary", f"""
SELECT YEAR, {', '.join(f'avg({c}) AS {c}' for c in Q_COLS.split())},
  sum(non_malaria_all_cause_outpatients) AS non_malaria_all_cause_outpatients, sum(presumed_cases) AS presumed_cases
FROM v_quality GROUP BY 1""", Q_COLS)
def _(t):
    return Q.national_summary(Q.quality_of_care(t.routine))


@query("D49_annual_sum_with_classes", """
SELECT ADM2_ID, YEAR, ANNUAL, CASE WHEN ANNUAL < 400 THEN '< 400mm' WHEN ANNUAL < 800 THEN '[400-800)mm'
  WHEN ANNUAL < 1600 THEN '[800-1600)mm' WHEN ANNUAL < 3200 THEN '[1600-3200)mm' ELSE '>= 3200mm' END AS class
FROM (SELECT ADM2_ID, YEAR, sum(CONF) AS ANNUAL FROM v_district_month GROUP BY ALL)""")
def _(t):
    df = T.annual_sums(t.district_month, "CONF")
    return df.withColumn("class", cut_half_open("ANNUAL", [0, 400, 800, 1600, 3200, 1e12], 0, "mm"))


@query("D49_national_monthly_mean", "SELECT YEAR, MONTH, avg(CONF) AS CONF FROM v_district_month GROUP BY ALL", "CONF")
def _(t):
    return t.district_month.groupBy("YEAR", "MONTH").agg(F.avg("CONF").alias("CONF"))


@query("D50_element_months", """
WITH s AS (SELECT INDICATOR, PERIOD, sum(VALUE) FILTER (WHERE VALUE > 220) AS VALUE FROM v_long GROUP BY ALL),
g AS (SELECT INDICATOR, unnest(generate_series(make_date(min(PERIOD) // 100, min(PERIOD) % 100, 1)::TIMESTAMP,
  make_date(max(PERIOD) // 100, max(PERIOD) % 100, 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS d FROM s GROUP BY 1)
SELECT g.INDICATOR, CAST(year(d) * 100 + month(d) AS INTEGER) AS PERIOD, coalesce(s.VALUE, 0) AS VALUE
FROM g LEFT JOIN s ON s.INDICATOR = g.INDICATOR AND s.PERIOD = year(d) * 100 + month(d)""")
def _(t):
    return T.element_months(t.long.withColumn("VALUE", F.when(F.col("VALUE") > 220, F.col("VALUE"))))


@query("D51_national_months", "SELECT PERIOD, sum(SUSP) AS SUSP, sum(TEST) AS TEST FROM v_routine GROUP BY 1")
def _(t):
    return T.national_months(t.routine, ["SUSP", "TEST"])


@query("D51_group_shares", """
SELECT ADM2_ID, 'MALADM' AS "GROUP", a AS VALUE, a / nullif(a + b, 0) * 100 AS SHARE FROM
  (SELECT ADM2_ID, coalesce(sum(MALADM), 0) AS a, coalesce(sum(ALLADM), 0) AS b FROM v_routine GROUP BY 1)
UNION ALL SELECT ADM2_ID, 'ALLADM', b, b / nullif(a + b, 0) * 100 FROM
  (SELECT ADM2_ID, coalesce(sum(MALADM), 0) AS a, coalesce(sum(ALLADM), 0) AS b FROM v_routine GROUP BY 1)""", "SHARE")
def _(t):
    return T.group_shares(t.routine, ["MALADM", "ALLADM"])


@query("D52_outlier_counts", """
SELECT INDICATOR, count(*) AS n_values, count(*) FILTER (WHERE OUTLIER) AS n_outliers,
  count(DISTINCT OU_ID) FILTER (WHERE OUTLIER) AS n_facilities, count(*) FILTER (WHERE OUTLIER) / count(*) * 100 AS pct_outliers
FROM v_flag_iqr GROUP BY 1""", "pct_outliers")
def _(t):
    return O.outlier_counts(O.flag_series(t.long, "IQR"), ["INDICATOR"])


@query("D52_outliers_by_date", """
SELECT INDICATOR, YEAR, MONTH, sum(VALUE) AS total, bool_or(OUTLIER) AS has_outlier FROM v_flag_iqr GROUP BY ALL""")
def _(t):
    return O.outliers_by_date(O.flag_series(t.long, "IQR"))


@query("D53_population_totals", "SELECT YEAR, sum(POPULATION) AS POPULATION FROM v_population GROUP BY 1")
def _(t):
    return Pop.totals_by_year(t.population)


@query("D55_yearly_mean_rate", "SELECT ADM2_ID, YEAR, avg(REPORTING_RATE) AS r FROM v_rate GROUP BY ALL", "r")
def _(t):
    return R.yearly_mean_rate(t.rate, "r")


@query("D56_equal_frequency_breaks", """
SELECT p AS prob, quantile_cont(ALLOUT, p) AS "break" FROM v_routine,
  (SELECT unnest([0.0::DOUBLE, 0.2, 0.4, 0.6, 0.8, 1.0]) AS p) GROUP BY 1""".replace("quantile_cont(ALLOUT, p)", """
  CASE p WHEN 0.0 THEN quantile_cont(ALLOUT, 0.0) WHEN 0.2 THEN quantile_cont(ALLOUT, 0.2) WHEN 0.4 THEN quantile_cont(ALLOUT, 0.4)
  WHEN 0.6 THEN quantile_cont(ALLOUT, 0.6) WHEN 0.8 THEN quantile_cont(ALLOUT, 0.8) ELSE quantile_cont(ALLOUT, 1.0) END"""),
       "prob break")
def _(t):
    return T.equal_frequency_breaks(t.routine, "ALLOUT", 5)


@query("D56_quantiles_by_district", """
SELECT ADM2_ID, CAST(0.25 AS DOUBLE) AS prob, quantile_cont(l_extendedprice, 0.25) AS quantile FROM lineitem
  JOIN v_pyramid ON OU_ID = 'F' || l_suppkey GROUP BY 1
UNION ALL SELECT ADM2_ID, 0.9, quantile_cont(l_extendedprice, 0.9) FROM lineitem JOIN v_pyramid ON OU_ID = 'F' || l_suppkey GROUP BY 1""",
       "quantile")
def _(t):
    li = t.raw_table("lineitem").select(F.concat(F.lit("F"), "l_suppkey").alias("OU_ID"), "l_extendedprice")
    return exact_quantiles(J.attach(li, t.pyramid, ["OU_ID"], ["ADM2_ID"]), "l_extendedprice", [0.25, 0.9], ["ADM2_ID"])


VIEWS["v_counted"] = """
SELECT row_number() OVER (ORDER BY v) AS idx, v, sum(c) OVER (ORDER BY v) AS n, sum(c * v) OVER (ORDER BY v) AS s, sum(c * v * v) OVER (ORDER BY v) AS q
FROM (SELECT CONF::DOUBLE AS v, count(*)::DOUBLE AS c FROM v_district_month WHERE CONF IS NOT NULL GROUP BY 1)"""
_WITHIN = "(j.q - i.q) - (j.s - i.s) * (j.s - i.s) / (j.n - i.n)"
VIEWS["v_class1"] = "SELECT *, q - s * s / n AS cost, 0::BIGINT AS cut FROM v_counted"
for _k in (2, 3, 4):
    VIEWS[f"v_class{_k}"] = f"""
SELECT j.idx, j.v, j.n, j.s, j.q, min(i.cost + {_WITHIN}) AS cost, arg_min(i.idx, i.cost + {_WITHIN}) AS cut
FROM v_counted j JOIN v_class{_k - 1} i ON i.idx < j.idx GROUP BY ALL"""


@query("D56_k_means_breaks", """
WITH z AS (SELECT max(idx) AS idx FROM v_counted),
e4 AS (SELECT idx, cut FROM v_class4 WHERE idx = (SELECT idx FROM z)), e3 AS (SELECT idx, cut FROM v_class3 WHERE idx = (SELECT cut FROM e4)),
e2 AS (SELECT idx, cut FROM v_class2 WHERE idx = (SELECT cut FROM e3)),
ends AS (SELECT 1 AS k, idx FROM v_class1 WHERE idx = (SELECT cut FROM e2) UNION ALL SELECT 2, idx FROM e2 UNION ALL SELECT 3, idx FROM e3 UNION ALL SELECT 4, idx FROM e4),
m AS (SELECT k, (s - coalesce(lag(s) OVER (ORDER BY k), 0)) / (n - coalesce(lag(n) OVER (ORDER BY k), 0)) AS mean FROM ends JOIN v_counted USING (idx))
SELECT 0::BIGINT AS k, min(v) AS "break" FROM v_counted UNION ALL SELECT 4, max(v) FROM v_counted
UNION ALL SELECT k - 1, (mean + before) / 2 FROM (SELECT k, mean, lag(mean) OVER (ORDER BY k) AS before FROM m) WHERE before IS NOT NULL""", "break")
def _(t):
    breaks = T.k_means_breaks(t.district_month, "CONF", 4)
    return t.spark.createDataFrame(list(enumerate(breaks)), "k long, break double")


@query("D56_k_means_classes")
def _(t):
    breaks = T.k_means_breaks(t.district_month, "CONF", 4)
    rounded = [0.0, *T.rounded_breaks(breaks)]
    return t.district_month.select("ADM2_ID", "PERIOD", "CONF", cut_half_open("CONF", [*rounded[:-1], 1e12], 0, "").alias("class"))


@query("D57_series_count", "SELECT count(*) AS n FROM (SELECT DISTINCT OU_ID, INDICATOR FROM v_long)")
def _(t):
    return K.count_distinct_keys(t.long, ["OU_ID", "INDICATOR"])




@query("K14_merged_facility_levels", """
SELECT DISTINCT OU_ID, ADM2_ID, coalesce(NULL, CASE WHEN OPENING_DATE IS NULL THEN 'hospital' END) AS kind FROM v_pyramid""")
def _(t):
    hospitals = t.pyramid.filter("OPENING_DATE is null").select("OU_ID", "ADM2_ID", F.lit("hospital").alias("kind"))
    others = t.pyramid.filter("OPENING_DATE is not null").select("OU_ID", "ADM2_ID")
    return R.merge_facility_levels(hospitals, others)
