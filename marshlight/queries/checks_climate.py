"""Gridded data by district."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import climate as C
from .registry import query
from .standins import VIEWS

VIEWS["v_daily_sum"] = """
SELECT ADM2_ID, CAST(ts AS DATE) AS DATE, sum(m) * 1000 AS MEAN, sum(lo) * 1000 AS MIN, sum(hi) * 1000 AS MAX FROM (
  SELECT ADM2_ID, ts, avg(value) AS m, min(value) AS lo, max(value) AS hi FROM v_climate GROUP BY 1, 2) GROUP BY 1, 2"""
VIEWS["v_daily_avg"] = """
SELECT ADM2_ID, DATE, avg(m) - 273.15 AS MEAN, avg(lo) - 273.15 AS MIN, avg(hi) - 273.15 AS MAX FROM (
  SELECT ADM2_ID, lon, lat, CAST(ts AS DATE) AS DATE, avg(value) AS m, min(value) AS lo, max(value) AS hi
  FROM v_climate GROUP BY ALL) GROUP BY 1, 2"""
S3 = "MEAN MIN MAX"
_KEYS = """strftime(DATE, '%GW%V') AS WEEK, strftime(DATE, '%Y%m') AS PERIOD,
  year(mid) || 'ThuW' || lpad(CAST((dayofyear(mid) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS EPI_WEEK"""
for _v in ("sum", "avg"):
    VIEWS[f"v_day_{_v}"] = f"""
SELECT * EXCLUDE (mid), {_KEYS} FROM (SELECT *, DATE - CAST((isodow(DATE) + 3) % 7 AS INTEGER) + 3 AS mid FROM v_daily_{_v})"""


def rain(t):
    return C.daily_table(t.climate, accumulated=True, scale=1000.0)


def heat(t):
    return C.daily_table(t.climate, accumulated=False, offset=-273.15)


def text_date(df):
    return df.withColumn("DATE", F.date_format("DATE", "yyyy-MM-dd"))


@query("D15_K26_daily_accumulated", "SELECT * REPLACE (strftime(DATE, '%Y-%m-%d') AS DATE) FROM v_day_sum", S3)
def _(t):
    return text_date(rain(t))


@query("D15_K26_daily_average", "SELECT * REPLACE (strftime(DATE, '%Y-%m-%d') AS DATE) FROM v_day_avg", S3)
def _(t):
    return text_date(heat(t))


for _key in ("WEEK", "EPI_WEEK", "PERIOD"):
    query(f"D14_K26_{_key.lower()}_sums", f"""
SELECT ADM2_ID, {_key}, sum(MEAN) AS MEAN, sum(MIN) AS MIN, sum(MAX) AS MAX FROM v_day_sum GROUP BY 1, 2""", S3)(
        lambda t, k=_key: C.by_period(rain(t), k, accumulated=True))
    query(f"D14_K26_{_key.lower()}_means", f"""
SELECT ADM2_ID, {_key}, avg(MEAN) AS MEAN, avg(MIN) AS MIN, avg(MAX) AS MAX FROM v_day_avg GROUP BY 1, 2""", S3)(
        lambda t, k=_key: C.by_period(heat(t), k, accumulated=False))


@query("K26_month_columns", """
SELECT ADM2_ID, PERIOD, avg(MEAN) AS MEAN, CAST(substr(PERIOD, 1, 4) AS INTEGER) AS YEAR, CAST(substr(PERIOD, 5, 2) AS INTEGER) AS MONTH
FROM v_day_avg GROUP BY 1, 2""", "MEAN")
def _(t):
    return C.month_columns(C.by_period(heat(t), "PERIOD", accumulated=False)).select("ADM2_ID", "PERIOD", "MEAN", "YEAR", "MONTH")


def _yearly_cells(t):
    return t.cells.select("lon", "lat", "value", (F.col("label") % 2 + 2020).alias("YEAR"))


VIEWS["v_zone"] = "SELECT d.ADM2_ID, c.* FROM v_cells c JOIN v_cell_district d USING (lon, lat)"


@query("D16_K27_district_population", """
SELECT ADM2_ID, CAST(label % 2 + 2020 AS INTEGER) AS YEAR, CAST(round_even(sum(value), 0) AS BIGINT) AS POPULATION,
  count(value) AS CELLS FROM v_zone GROUP BY 1, 2""")
def _(t):
    return C.district_population(_yearly_cells(t), t.district_cells)


@query("D17_K28_metric_means", """
SELECT ADM2_ID, CAST('Pf_Parasite_Rate' AS VARCHAR) AS metric, CAST(label % 2 + 2020 AS INTEGER) AS year,
  CASE label % 3 WHEN 0 THEN 'MEAN' WHEN 1 THEN 'LCI' ELSE 'UCI' END AS STATISTIC, avg(value) AS VALUE FROM v_zone GROUP BY ALL""", "VALUE")
def _(t):
    k = F.col("label") % 3
    cells = t.cells.select("lon", "lat", "value", F.lit("Pf_Parasite_Rate").alias("metric"), (F.col("label") % 2 + 2020).alias("year"),
                           F.when(k == 0, "Data").when(k == 1, "LCI").otherwise("UCI").alias("band"))
    return C.metric_means(cells, t.district_cells)


@query("C13_K26_cell_days_by_district", """
WITH v AS (SELECT c.lon, c.lat, date_trunc('hour', e.ts) AS ts, max(e.value) AS value FROM events e JOIN v_cells c ON c.vec_id = e.user_id % 200 GROUP BY ALL),
d AS (SELECT lon, lat, CAST(ts AS DATE) AS day, avg(value) AS m, min(value) AS lo, max(value) AS hi FROM v GROUP BY ALL)
SELECT ADM2_ID, strftime(day, '%Y-%m-%d') AS DATE, round(avg(m) + 1e-7, 3) AS MEAN, round(avg(lo) + 1e-7, 3) AS MIN, round(avg(hi) + 1e-7, 3) AS MAX FROM d JOIN v_cell_district USING (lon, lat) GROUP BY ALL""", S3)
def _(t):
    steps = t.raw_table("events").join(t.cells.select("vec_id", "lon", "lat"), F.col("vec_id") == F.col("user_id") % 200).groupBy(
        "lon", "lat", F.date_trunc("hour", "ts").alias("ts")).agg(F.max("value").alias("value"))
    days = text_date(C.daily_average_of_cells(steps, t.district_cells))
    return days.withColumns({c: F.round(F.col(c) + 1e-7, 3) for c in C.STATS})  # the order of a sum must not decide a tie
