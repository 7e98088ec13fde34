"""Incidence, surveys and the assembled results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.survey import domain_means, indicator_table
from ..plans import assemble as Z
from ..plans import incidence as I
from ..plans import outliers as O
from ..plans import seasonality as Se
from ..plans import survey as V
from ..sources.config import metadata_table, update_metadata
from .checks_agg import Y_COLS, yearly
from .registry import query
from .standins import INDICATORS, VIEWS


@query("K15_monthly_cases", "SELECT * EXCLUDE (CARESEEKING_PCT, ADM1_ID) FROM v_n3", "REPORTING_RATE TPR N1 N2 N3")
def _(t):
    return I.monthly_cases(t.routine, t.rate, "PRES", I.care_seeking(t.care, "PCT")).drop("CARESEEKING_PCT", "ADM1_ID")


@query("K15_yearly_incidence", "SELECT * FROM v_yearly", Y_COLS)
def _(t):
    return yearly(t)


@query("H15_rates_per_thousand", """
SELECT ADM2_ID, YEAR, INCIDENCE_CRUDE, INCIDENCE_ADJ_TESTING FROM v_yearly""", "INCIDENCE_CRUDE INCIDENCE_ADJ_TESTING")
def _(t):
    return yearly(t).select("ADM2_ID", "YEAR", "INCIDENCE_CRUDE", "INCIDENCE_ADJ_TESTING")


VIEWS["v_crude_group"] = """
SELECT r.ADM2_ID, r.YEAR, r.CONF, r.CONF / nullif(p.POP_UNDER_5, 0) * 1000 AS INCIDENCE_CRUDE FROM (
  SELECT ADM2_ID, YEAR, coalesce(sum(MALDTH), 0) AS CONF FROM v_routine GROUP BY 1, 2) r LEFT JOIN v_population p USING (ADM2_ID, YEAR)"""


@query("K15_incidence_of_a_group", "SELECT ADM2_ID, YEAR, CONF, INCIDENCE_CRUDE FROM v_crude_group", "INCIDENCE_CRUDE")
def _(t):
    df = t.routine.withColumns({"SUSP_UNDER_5": F.col("MALADM"), "TEST_UNDER_5": F.col("ALLADM"), "CONF_UNDER_5": F.col("MALDTH")})
    return I.incidence(df, t.rate, t.population, "SUSP-TEST", group="UNDER_5").select("ADM2_ID", "YEAR", "CONF", "INCIDENCE_CRUDE")


# --- surveys ----------------------------------------------------------------------------------------


def _estimates_sql(ys: dict[str, str], source: str, weight: str = "V005 / 1e6") -> str:
    """Linearised domain means written without the library's zero-score shortcut: every cluster has a row."""
    long = " UNION ALL ".join(
        f"SELECT ADM1_NAME AS domain, V023 AS stratum, V021 AS cluster, {weight} AS w, '{n}' AS indicator, CAST({e} AS DOUBLE) AS y FROM {source}"
        for n, e in ys.items())
    return f"""
WITH raw AS ({long}), known AS (SELECT * FROM raw WHERE y IS NOT NULL),
means AS (SELECT domain, indicator, sum(w) AS sw, sum(w * y) / nullif(sum(w), 0) AS estimate FROM known GROUP BY ALL),
clusters AS (SELECT DISTINCT stratum, cluster FROM raw),
scores AS (SELECT m.domain, m.indicator, m.estimate, c.stratum, c.cluster,
    coalesce(sum(k.w * (k.y - m.estimate) / m.sw), 0) AS z
  FROM means m CROSS JOIN clusters c LEFT JOIN known k ON k.domain = m.domain AND k.indicator = m.indicator
    AND k.stratum = c.stratum AND k.cluster = c.cluster GROUP BY ALL),
parts AS (SELECT domain, indicator, estimate, stratum, CASE WHEN count(*) > 1 THEN count(*) / (count(*) - 1) *
    sum((z - zm) * (z - zm)) ELSE 0 END AS v FROM (SELECT *, avg(z) OVER (PARTITION BY domain, indicator, stratum) AS zm FROM scores)
  GROUP BY ALL)
SELECT domain, indicator, estimate, sqrt(sum(v)) AS se FROM parts GROUP BY ALL"""


def _wide_sql(ys: dict[str, str], source: str, how: str = "LEFT") -> tuple[str, str]:
    cols, names = [], []
    for n in ys:
        for col, e in (("SAMPLE_AVERAGE", "estimate"), ("CI_LOWER_BOUND", "greatest(estimate - 1.959963984540054 * se, 0.0)"),
                       ("CI_UPPER_BOUND", "least(estimate + 1.959963984540054 * se, 1.0)")):
            cols.append(f"max({e} * 100) FILTER (WHERE indicator = '{n}') AS {n.upper()}_{col}")
            names.append(f"{n.upper()}_{col}")
    sql = (f"SELECT a.ADM1_NAME, a.ADM1_ID, {', '.join(names)} FROM (SELECT DISTINCT ADM1_ID, ADM1_NAME FROM v_admin) a "
           f"{how} JOIN (SELECT domain, {', '.join(cols)} FROM ({_estimates_sql(ys, source)}) GROUP BY 1) e ON e.domain = a.ADM1_NAME")
    return sql, " ".join(names)


def _regions(t):
    return t.admin.select("ADM1_ID", "ADM1_NAME").distinct()


_DESIGN = {"URGENT": "CASE WHEN n_urgent > 2 THEN 1 ELSE 0 END", "OPEN_SHARE": "CASE WHEN n_orders > 0 THEN n_open / n_orders END"}


@query("D26_survey_domain_means", _estimates_sql(_DESIGN, "v_survey"), "estimate se")
def _(t):
    df = V.with_weight(t.survey, "V005").withColumns({
        "URGENT": (F.col("n_urgent") > 2).cast("int"), "OPEN_SHARE": F.try_divide("n_open", "n_orders")})
    return domain_means(df, ["URGENT", "OPEN_SHARE"], "ADM1_NAME", "wt", "V021", "V023")


VIEWS["v_house"] = """
SELECT *, least(2.0 * (coalesce(n1, 0) + coalesce(n2, 0)), HV013) AS potential_users FROM (
  SELECT ADM1_NAME, V021, V023, V005, CASEID, CAST(n_orders AS INTEGER) AS HV013, CASE WHEN n_urgent > 0 THEN n_urgent END AS n1,
    CASE WHEN n_open > 2 THEN 1 END AS n2 FROM v_survey)"""
VIEWS["v_person"] = """
SELECT o_custkey AS CASEID, CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 1 END AS HV103,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 0 END AS HML12 FROM orders"""
VIEWS["v_nights"] = """
SELECT CASEID, CAST(coalesce(sum(HV103), 0) AS BIGINT) AS total_slept,
  CAST(coalesce(sum(CASE WHEN HV103 IS NOT NULL THEN CAST(HV103 = 1 AND coalesce(HML12 IN (1, 2), false) AS INTEGER) END), 0) AS BIGINT)
    AS total_slept_itn FROM v_person GROUP BY 1"""


def _house(t):
    return t.survey.select("ADM1_NAME", "V021", "V023", "V005", "CASEID", F.col("n_orders").cast("int").alias("HV013"),
                           F.when(F.col("n_urgent") > 0, F.col("n_urgent")).alias("n1"), F.when(F.col("n_open") > 2, 1).alias("n2"))


def _persons(t):
    o = t.raw_table("orders")
    slept = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderpriority") != "3-MEDIUM", 1)
    net = (F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2)
           .when(F.col("o_orderpriority") == "5-LOW", 0))
    return o.select(F.col("o_custkey").alias("CASEID"), slept.alias("HV103"), net.alias("HML12"))


@query("D29_net_access", """
SELECT CASEID, potential_users, total_slept, potential_users / total_slept AS PCT_ITN_ACCESS
FROM v_house JOIN v_nights USING (CASEID) WHERE total_slept > 0""", "PCT_ITN_ACCESS")
def _(t):
    return V.net_access(_house(t), _persons(t), ["n1", "n2"], key=["CASEID"]).select(
        "CASEID", "potential_users", "total_slept", "PCT_ITN_ACCESS")


@query("D30_net_use", """
SELECT CASEID, total_slept, total_slept_itn, total_slept_itn / nullif(total_slept, 0) AS PCT_ITN_USE
FROM v_house JOIN v_nights USING (CASEID)""", "PCT_ITN_USE")
def _(t):
    return V.net_use(_house(t), _persons(t), key=["CASEID"]).select("CASEID", "total_slept", "total_slept_itn", "PCT_ITN_USE")


VIEWS["v_access"] = "SELECT *, potential_users / total_slept AS y FROM v_house JOIN v_nights USING (CASEID) WHERE total_slept > 0"
VIEWS["v_use"] = "SELECT *, total_slept_itn / nullif(total_slept, 0) AS y FROM v_house JOIN v_nights USING (CASEID)"
for _name, _view, _job in (("PCT_ITN_ACCESS", "v_access", lambda t: V.net_access(_house(t), _persons(t), ["n1", "n2"], key=["CASEID"])),
                           ("PCT_ITN_USE", "v_use", lambda t: V.net_use(_house(t), _persons(t), key=["CASEID"]))):
    _sql, _cols = _wide_sql({_name: "y"}, _view)
    query(f"K21_{_name.lower()}_by_region", _sql, _cols)(
        lambda t, n=_name, j=_job: indicator_table(V.with_weight(j(t), "V005"), [n], _regions(t)))


_CARE = {"PCT_PUBLIC_CARE": "CASE WHEN coalesce(n_urgent > 2, false) OR coalesce(n_open > 5, false) THEN 1 ELSE 0 END",
         "PCT_PRIVATE_CARE": "CASE WHEN age < 30 THEN 1 ELSE 0 END",
         "PCT_NO_CARE": "CASE WHEN NOT (n_urgent > 2 OR n_open > 5) AND NOT age < 30 THEN 1 ELSE 0 END"}


def _care(t):
    df = t.survey.withColumns({"H32A": (F.col("n_urgent") > 2).cast("int"), "H32B": F.when(F.col("n_open") > 5, 1),
                               "H32S": F.when(F.col("age") < 30, 1)})
    return V.care_flags(V.with_weight(df, "V005"), ["H32A", "H32B"], ["H32S"])


@query("D31_care_flags", f"SELECT CASEID, {', '.join(f'{e} AS {n}' for n, e in _CARE.items())} FROM v_survey")
def _(t):
    return _care(t).select("CASEID", *_CARE)


@query("K22_care_seeking_by_region", (lambda w: "SELECT ADM1_NAME, ADM1_ID, " + ", ".join(
    f"{n}_SAMPLE_AVERAGE AS {n}" for n in _CARE) + f" FROM ({w[0]})")(_wide_sql(_CARE, "v_survey", "INNER")), " ".join(_CARE))
def _(t):
    return V.care_summary(_care(t), _regions(t))


_TESTED = "(SELECT *, CASE WHEN n_urgent IN (0, 1) THEN n_urgent END AS y FROM v_survey WHERE age BETWEEN 6 AND 59)"
_PREV_SQL, _PREV_COLS = _wide_sql({"PREV": "y"}, _TESTED)


@query("K23_prevalence_by_region", _PREV_SQL, _PREV_COLS)
def _(t):
    p = t.survey.withColumns({"HC1": F.col("age"), "HV103": F.lit(1), "HV042": F.lit(1), "HML32": F.col("n_urgent")})
    df = V.test_result(V.tested_children(V.with_weight(p, "V005")), "HML32", "PREV")
    return indicator_table(df, ["PREV"], _regions(t))


VIEWS["v_dose"] = """
SELECT ADM1_NAME, V021, V023, V005, CASEID, CASE WHEN d2 = 1 OR d3 = 1 THEN 1 ELSE d1 END AS DTP1,
  CASE WHEN d3 = 1 THEN 1 ELSE d2 END AS DTP2, d3 AS DTP3 FROM (
  SELECT *, CASE WHEN n_urgent = 0 THEN 0 WHEN n_urgent IN (1, 2, 3) THEN 1 END AS d1,
    CASE WHEN n_open = 0 THEN 0 WHEN n_open IN (1, 2, 3) THEN 1 END AS d2,
    CASE WHEN n_orders % 9 = 0 THEN 0 WHEN n_orders % 9 IN (1, 2, 3) THEN 1 END AS d3 FROM v_survey)"""
_DOSES = {f"DTP{i}": f"DTP{i}" for i in (1, 2, 3)}
_DOSE_SQL, _DOSE_COLS = _wide_sql(_DOSES, "v_dose")


def _doses(t):
    k = t.survey.withColumns({"H3": F.col("n_urgent"), "H5": F.col("n_open"), "H7": F.col("n_orders") % 9})
    return V.dose_flags(V.with_weight(k, "V005"))


@query("D28_dose_flags", "SELECT CASEID, DTP1, DTP2, DTP3 FROM v_dose")
def _(t):
    return _doses(t).select("CASEID", "DTP1", "DTP2", "DTP3")


@query("K24_vaccination_by_region", _DOSE_SQL, _DOSE_COLS)
def _(t):
    return indicator_table(_doses(t), list(_DOSES), _regions(t))


@query("D28_K24_dropout", f"""
SELECT ADM1_ID, (1 - DTP2_SAMPLE_AVERAGE / nullif(DTP1_SAMPLE_AVERAGE, 0)) * 100 AS DROPOUT_DTP1_DTP2,
  (1 - DTP3_SAMPLE_AVERAGE / nullif(DTP2_SAMPLE_AVERAGE, 0)) * 100 AS DROPOUT_DTP2_DTP3,
  (1 - DTP3_SAMPLE_AVERAGE / nullif(DTP1_SAMPLE_AVERAGE, 0)) * 100 AS DROPOUT_DTP1_DTP3 FROM ({_DOSE_SQL})""",
       "DROPOUT_DTP1_DTP2 DROPOUT_DTP2_DTP3 DROPOUT_DTP1_DTP3")
def _(t):
    return V.dropout(indicator_table(_doses(t), list(_DOSES), _regions(t))).select(
        "ADM1_ID", "DROPOUT_DTP1_DTP2", "DROPOUT_DTP2_DTP3", "DROPOUT_DTP1_DTP3")


VIEWS["v_births"] = """
SELECT V024, V021, V023, V005, 1400 AS V008, 1399 - CAST(o_orderkey % 180 AS INTEGER) AS B3,
  CASE WHEN o_totalprice > 350000 THEN CAST(o_orderkey % 61 AS INTEGER) END AS B7 FROM orders JOIN v_survey ON o_custkey = CASEID"""
VIEWS["v_seg_cells"] = """
SELECT V024, V021, s.seg, sum(w * share) AS e, sum(CASE WHEN B7 >= lo AND B7 < hi THEN w * dshare ELSE 0 END) AS d FROM (
  SELECT b.*, s.*, V005 / 1e6 AS w,
    CASE WHEN B3 + lo >= 1280 AND B3 + hi <= 1400 THEN 1.0 WHEN B3 + lo < 1280 AND B3 + hi > 1280 AND B3 + hi <= 1400 THEN 0.5
      WHEN B3 + lo >= 1280 AND B3 + lo < 1400 AND B3 + hi > 1400 THEN 0.5 ELSE 0.0 END AS share,
    CASE WHEN B3 + lo < 1280 AND B3 + hi > 1280 AND B3 + hi <= 1400 THEN 0.5 ELSE 1.0 END AS dshare
  FROM v_births b CROSS JOIN (VALUES (0, 0, 1), (1, 1, 3), (2, 3, 6), (3, 6, 12), (4, 12, 24), (5, 24, 36), (6, 36, 48), (7, 48, 60))
    s(seg, lo, hi) WHERE B7 IS NULL OR B7 >= lo) s WHERE share > 0 GROUP BY ALL"""
VIEWS["v_u5"] = """
SELECT V024, (1 - product(1 - coalesce(d / nullif(e, 0), 0))) * 1000 AS R FROM (
  SELECT V024, seg, sum(d) AS d, sum(e) AS e FROM v_seg_cells GROUP BY ALL) GROUP BY 1"""
VIEWS["v_u5_left"] = """
SELECT V024, out, (1 - product(1 - coalesce(d / nullif(e, 0), 0))) * 1000 AS r FROM (
  SELECT c.V024, o.V021 AS out, c.seg, sum(c.d) AS d, sum(c.e) AS e FROM v_seg_cells c
  JOIN (SELECT DISTINCT V024, V021 FROM v_seg_cells) o ON o.V024 = c.V024 AND o.V021 <> c.V021 GROUP BY ALL) GROUP BY ALL"""
VIEWS["v_mortality"] = """
SELECT V024, R, se, greatest(R - 1.96 * se, 0) AS LCI, R + 1.96 * se AS UCI FROM (
  SELECT u.V024, u.R, sqrt(sum((count_ * u.R - (count_ - 1) * l.r - u.R) ** 2) / (any_value(count_) * (any_value(count_) - 1))) AS se
  FROM v_u5 u JOIN (SELECT *, count(*) OVER (PARTITION BY V024) AS count_ FROM v_u5_left) l USING (V024) GROUP BY 1, 2)"""


def _births(t):
    o = t.raw_table("orders").join(t.survey, F.col("o_custkey") == F.col("CASEID"))
    return o.select("V024", "V021", "V023", "V005", F.lit(1400).alias("V008"),
                    (1399 - F.col("o_orderkey") % 180).cast("int").alias("B3"),
                    F.when(F.col("o_totalprice") > 350000, (F.col("o_orderkey") % 61).cast("int")).alias("B7"))


@query("D27_U3_under_five_mortality", "SELECT * FROM v_mortality", "R se LCI UCI")
def _(t):
    from ..operators.survey import under_five_mortality

    return under_five_mortality(_births(t))


@query("K25_mortality_by_region", """
SELECT a.ADM1_NAME, a.ADM1_ID, m.R AS U5MR_SAMPLE_AVERAGE, m.LCI AS U5MR_CI_LOWER_BOUND, m.UCI AS U5MR_CI_UPPER_BOUND
FROM (SELECT DISTINCT ADM1_NAME, ADM1_ID FROM v_admin) a JOIN v_mortality m ON 'R' || m.V024 = a.ADM1_ID""",
       "U5MR_SAMPLE_AVERAGE U5MR_CI_LOWER_BOUND U5MR_CI_UPPER_BOUND")
def _(t):
    labels = t.survey.select("ADM1_NAME", F.col("V024").alias("DHS_ADM1_CODE")).distinct()
    return V.mortality_table(_births(t), labels, _regions(t))


# --- assembled results ------------------------------------------------------------------------------

VIEWS["v_metrics"] = """
SELECT ADM2_ID, CASE m.n WHEN 1 THEN 'Pf_Parasite_Rate' ELSE 'IRS_Coverage' END AS METRIC_NAME, YEAR, s.STATISTIC,
  sum(CONF) / (1000 * m.n) / CASE s.STATISTIC WHEN 'MEAN' THEN 1 ELSE 2 END AS VALUE
FROM v_district_month CROSS JOIN (VALUES (1), (2)) m(n) CROSS JOIN (VALUES ('MEAN'), ('LCI')) s(STATISTIC)
WHERE m.n = 1 OR YEAR < 2000 GROUP BY ADM2_ID, m.n, YEAR, s.STATISTIC"""


def _metrics(t):
    y = t.district_month.groupBy("ADM2_ID", "YEAR").agg(F.sum("CONF").alias("c"))
    rows = F.array(*[F.struct(F.lit(n).alias("METRIC_NAME"), F.lit(s).alias("STATISTIC"), (F.col("c") / d).alias("VALUE"), F.lit(last).alias("last"))
                     for n, k, last in (("Pf_Parasite_Rate", 1000, 9999), ("IRS_Coverage", 2000, 1999))
                     for s, d in (("MEAN", k), ("LCI", k * 2))])
    return y.withColumn("r", F.explode(rows)).select("ADM2_ID", "YEAR", "r.*").filter("YEAR <= last").drop("last")


@query("H31_scaled_metrics", """
SELECT ADM2_ID, round_even(max(VALUE) FILTER (WHERE METRIC_NAME = 'Pf_Parasite_Rate') * 100, 2) AS PF_PR_RATE,
  round_even(max(VALUE) FILTER (WHERE METRIC_NAME = 'IRS_Coverage') * 100, 2) AS IRS_COVERAGE_RATE
FROM (SELECT *, max(YEAR) OVER (PARTITION BY METRIC_NAME) AS last FROM v_metrics WHERE STATISTIC = 'MEAN') WHERE YEAR = last GROUP BY 1""")
def _(t):
    return Z.latest_metrics(_metrics(t)).select("ADM2_ID", "PF_PR_RATE", "IRS_COVERAGE_RATE")


@query("H32_region_values_to_districts", """
SELECT a.ADM2_ID, round_even(c.PCT * 100, 2) AS PCT_CARE FROM v_admin a LEFT JOIN (SELECT ADM1_ID, CASE WHEN ADM1_ID <> 'R1' THEN PCT END AS PCT FROM v_care) c USING (ADM1_ID)""")
def _(t):
    care = t.care.select("ADM1_ID", F.when(F.col("ADM1_ID") != "R1", F.col("PCT") * 100).alias("p"))
    out = Z.add_region_values(Z.empty_results(t.admin, ["PCT_CARE"]), care, {"p": "PCT_CARE"})
    return out.select("ADM2_ID", "PCT_CARE")


_VARS = ["POPULATION", "POP_UNDER_5", "REPORTING_RATE", "INCIDENCE_CRUDE", "INCIDENCE_ADJ_TESTING", "INCIDENCE_ADJ_REPORTING",
         "PF_PR_RATE", "IRS_COVERAGE_RATE", "SEASONALITY_RAINFALL", "SEASONAL_BLOCK_DURATION_RAINFALL", "PCT_CARE", "U5MR", "NEVER_FILLED"]


@query("K29_assembled_results", """
SELECT a.*, p.POPULATION, p.POP_UNDER_5, rr.REPORTING_RATE, i.INCIDENCE_CRUDE, i.INCIDENCE_ADJ_TESTING, i.INCIDENCE_ADJ_REPORTING,
  m.PF_PR_RATE, m.IRS_COVERAGE_RATE, CASE s.SEASONALITY WHEN 0 THEN 'not-seasonal' WHEN 1 THEN 'seasonal' END AS SEASONALITY_RAINFALL,
  CAST(s.BLOCK AS DOUBLE) AS SEASONAL_BLOCK_DURATION_RAINFALL, round_even(c.PCT * 100, 2) AS PCT_CARE, round_even(u.R, 2) AS U5MR,
  CAST(NULL AS DOUBLE) AS NEVER_FILLED
FROM v_admin a
LEFT JOIN (SELECT ADM2_ID, POPULATION, POP_UNDER_5 FROM v_population WHERE YEAR = 1996) p USING (ADM2_ID)
LEFT JOIN (SELECT ADM2_ID, round_even(avg(REPORTING_RATE) * 100, 1) AS REPORTING_RATE FROM v_rate GROUP BY 1) rr USING (ADM2_ID)
LEFT JOIN (SELECT ADM2_ID, round_even(avg(INCIDENCE_CRUDE), 2) AS INCIDENCE_CRUDE, round_even(avg(INCIDENCE_ADJ_TESTING), 2) AS INCIDENCE_ADJ_TESTING,
    round_even(avg(INCIDENCE_ADJ_REPORTING), 2) AS INCIDENCE_ADJ_REPORTING FROM v_yearly WHERE YEAR > (SELECT max(YEAR) - 3 FROM v_yearly) GROUP BY 1) i USING (ADM2_ID)
LEFT JOIN (SELECT ADM2_ID, round_even(max(VALUE) FILTER (WHERE METRIC_NAME = 'Pf_Parasite_Rate') * 100, 2) AS PF_PR_RATE,
    round_even(max(VALUE) FILTER (WHERE METRIC_NAME = 'IRS_Coverage') * 100, 2) AS IRS_COVERAGE_RATE
  FROM (SELECT *, max(YEAR) OVER (PARTITION BY METRIC_NAME) AS last FROM v_metrics WHERE STATISTIC = 'MEAN') WHERE YEAR = last GROUP BY 1) m USING (ADM2_ID)
LEFT JOIN v_season_block s USING (ADM2_ID) LEFT JOIN v_care c USING (ADM1_ID) LEFT JOIN v_u5 u ON 'R' || u.V024 = a.ADM1_ID""")
def _(t):
    from ..operators.survey import under_five_mortality

    t.use_staged_routine()  # written once; every table below reads it
    rain = Se.seasonality(
        t.district_month.select("ADM2_ID", "YEAR", "MONTH", F.col("RAIN").alias("VALUE")), "VALUE", "RAINFALL", "RAIN_PROPORTION",
        rainfall=True, threshold=0.3)
    care = t.care.select("ADM1_ID", (F.col("PCT") * 100).alias("p"))
    u5 = under_five_mortality(_births(t)).select(F.concat(F.lit("R"), "V024").alias("ADM1_ID"), "R")
    return Z.assemble(t.admin, _VARS, population=t.population, rate=t.rate, incidence=yearly(t), metrics=_metrics(t), rain=rain,
                      surveys=[(care, {"p": "PCT_CARE"}), (u5, {"R": "U5MR"})], years_back=-3,
                      population_year=1996)  # a table that runs on after its reference year


@query("K29_median_with_access_cases_and_user_layer", """
SELECT a.*, CASE WHEN ends_with(a.ADM2_ID, '1') THEN 123.5 ELSE p.POPULATION END AS POPULATION, rr.REPORTING_RATE, i.INCIDENCE_CRUDE,
  CASE s.SEASONALITY WHEN 0 THEN 'not-seasonal' WHEN 1 THEN 'seasonal' END AS SEASONALITY_CASES,
  CAST(s.BLOCK AS DOUBLE) AS SEASONAL_BLOCK_DURATION_CASES, x.PCT_HEALTH_ACCESS
FROM v_admin a
LEFT JOIN (SELECT ADM2_ID, POPULATION FROM v_population WHERE YEAR = (SELECT max(YEAR) FROM v_population)) p USING (ADM2_ID)
LEFT JOIN (SELECT ADM2_ID, round_even(median(REPORTING_RATE) * 100, 1) AS REPORTING_RATE FROM v_rate GROUP BY 1) rr USING (ADM2_ID)
LEFT JOIN (SELECT ADM2_ID, round_even(median(INCIDENCE_CRUDE), 2) AS INCIDENCE_CRUDE FROM v_yearly GROUP BY 1) i USING (ADM2_ID)
LEFT JOIN v_season_block s USING (ADM2_ID)
LEFT JOIN (SELECT ADM2_ID, count(*) FILTER (WHERE CONF > 20) * 100.0 / count(*) AS PCT_HEALTH_ACCESS FROM v_district_month GROUP BY 1) x USING (ADM2_ID)""",
       "PCT_HEALTH_ACCESS")
def _(t):
    t.use_staged_routine()
    cases = Se.seasonality(t.district_month.select("ADM2_ID", "YEAR", "MONTH", F.col("RAIN").alias("VALUE")), "VALUE", "CASES", "SHARE", threshold=0.3)
    access = t.district_month.groupBy("ADM2_ID").agg((F.count_if(F.col("CONF") > 20) * 100.0 / F.count(F.lit(1))).alias("PCT_HEALTH_ACCESS"))
    layer = t.admin.select("ADM2_ID", F.lit("other name").alias("ADM2_NAME"), F.when(F.endswith("ADM2_ID", F.lit("1")), "123.5").alias("POPULATION"),
                           F.lit("x").alias("NOT_A_VARIABLE"))
    variables = ["POPULATION", "REPORTING_RATE", "INCIDENCE_CRUDE", "SEASONALITY_CASES", "SEASONAL_BLOCK_DURATION_CASES", "PCT_HEALTH_ACCESS"]
    return Z.assemble(t.admin, variables, population=t.population, rate=t.rate, incidence=yearly(t), cases=cases, access=access,
                      user_layer=layer, rate_metric="median", incidence_metric="median")


@query("A14_K29_periods_used", """
SELECT v.VARIABLE, v.LABEL, coalesce(p.PERIOD, v.PERIOD) AS PERIOD FROM (VALUES ('POPULATION', 'people', NULL), ('POP_UNDER_5', 'children', NULL),
  ('REPORTING_RATE', 'rate', NULL), ('INCIDENCE_CRUDE', 'crude', NULL), ('PF_PR_RATE', 'parasite', NULL), ('IRS_COVERAGE_RATE', 'spraying', NULL),
  ('U5MR', 'deaths', '2018')) v(VARIABLE, LABEL, PERIOD)
LEFT JOIN (SELECT 'POPULATION' AS VARIABLE, '1996' AS PERIOD UNION ALL SELECT 'POP_UNDER_5', '1996'
  UNION ALL SELECT 'REPORTING_RATE', min(YEAR) || '-' || max(YEAR) FROM v_rate
  UNION ALL SELECT 'INCIDENCE_CRUDE', (max(YEAR) - 2) || '-' || max(YEAR) FROM v_yearly
  UNION ALL SELECT CASE METRIC_NAME WHEN 'Pf_Parasite_Rate' THEN 'PF_PR_RATE' ELSE 'IRS_COVERAGE_RATE' END, CAST(max(YEAR) AS VARCHAR)
    FROM v_metrics GROUP BY METRIC_NAME) p USING (VARIABLE)""")
def _(t):
    labels = {"POPULATION": "people", "POP_UNDER_5": "children", "REPORTING_RATE": "rate", "INCIDENCE_CRUDE": "crude", "PF_PR_RATE": "parasite",
              "IRS_COVERAGE_RATE": "spraying", "U5MR": "deaths"}
    meta = metadata_table(t.spark, {k: {"LABEL": v, "PERIOD": "2018" if k == "U5MR" else None} for k, v in labels.items()})
    used = Z.periods_used(t.population, t.rate, yearly(t).select("ADM2_ID", "YEAR", "INCIDENCE_CRUDE"), _metrics(t), years_back=-3, population_year=1996)
    return update_metadata(meta, used)


@query("K30_outlier_report", """
SELECT YEAR, INDICATOR, count(*) AS n_values, count(*) FILTER (WHERE OUTLIER) AS n_outliers,
  count(DISTINCT OU_ID) FILTER (WHERE OUTLIER) AS n_facilities, count(*) FILTER (WHERE OUTLIER) / count(*) * 100 AS pct_outliers
FROM v_flag_mean GROUP BY 1, 2""", "pct_outliers")
def _(t):
    return O.outlier_counts(O.run(t.routine, INDICATORS, "MEAN").detected, ["YEAR", "INDICATOR"])
