"""Reporting rates by district and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import any_true, ratio, row_sum, sum_zero
from ..functions.periods import year_of
from ..functions.text import name_is_closed
from ..operators.joins import attach, open_at_month_start, open_per_month
from ..operators.shape import wide_form, with_every_month
from ..sources.staging import stage

RATE_KEYS = ("ADM2_ID", "YEAR", "MONTH")
ADMIN = ("ADM1_ID", "ADM1_NAME", "ADM2_ID", "ADM2_NAME")
METRICS = ("ACTUAL_REPORTS", "EXPECTED_REPORTS")


# --- dataset method ---------------------------------------------------------------------------------


def chosen_products(reports: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Only the wanted products, provided every one of them occurs; otherwise all rows."""
    wanted = list(dict.fromkeys(wanted))
    found = reports.filter(F.col("PRODUCT_UID").isin(wanted)).agg(
        F.count_distinct("PRODUCT_UID").alias("n")).scalar()
    return reports.filter((found < len(wanted)) | F.col("PRODUCT_UID").isin(wanted))


def reports_wide(reports: DataFrame) -> DataFrame:
    keys = [c for c in reports.columns if c not in ("PRODUCT_METRIC", "VALUE")]
    return wide_form(reports, keys, METRICS, name="PRODUCT_METRIC")


def units_in_several_products(reports: DataFrame) -> DataFrame:
    return reports.groupBy("OU_ID").agg(F.count_distinct("PRODUCT_UID").alias("n_products")).filter("n_products > 1")


def deduplicate_reports(wide: DataFrame) -> DataFrame:
    """For facilities that report through several products, keep the rows with the month's highest value.

    Rows that tie are all kept, so agreeing products still count twice. A facility is treated in all its
    months once it is doubled in any. Nothing is removed when a doubled row holds anything but 0 or 1.
    The windows hold one facility's months and products.
    """
    known = F.coalesce(F.col("ACTUAL_REPORTS").isin(0, 1) & F.col("EXPECTED_REPORTS").isin(0, 1), F.lit(False))
    per_month = wide.groupBy("OU_ID", "PERIOD").agg(F.count(F.lit(1)).alias("n"), F.count_if(~known).alias("odd"))
    odd = per_month.filter("n > 1").agg(F.coalesce(F.sum("odd"), F.lit(0)).alias("odd")).scalar()
    month, unit = Window.partitionBy("OU_ID", "PERIOD"), Window.partitionBy("OU_ID")
    df = wide.repartition("OU_ID").withColumns({
        "_n": F.count(F.lit(1)).over(month),
        # one unknown value leaves the month's highest unknown
        "_best": F.when(F.count("ACTUAL_REPORTS").over(month) == F.count(F.lit(1)).over(month),
                        F.max("ACTUAL_REPORTS").over(month)),
    })
    df = df.withColumn("_doubled", F.max("_n").over(unit) > 1)
    keep = ~F.col("_doubled") | (odd > 0) | (F.col("ACTUAL_REPORTS") == F.col("_best"))
    return df.filter(keep).drop("_n", "_best", "_doubled")


def cap_reports(wide: DataFrame) -> DataFrame:
    """Counts above one become one (hospital sub-units reported as one facility)."""
    return wide.withColumns({c: F.least(F.col(c), F.lit(1.0)) for c in METRICS})


def district_rate(wide: DataFrame, keys: Sequence[str] = ("PERIOD", "YEAR", "MONTH", "ADM2_ID")) -> DataFrame:
    sums = wide.groupBy(*keys).agg(*[sum_zero(c).alias(c) for c in METRICS])
    return sums.withColumn("REPORTING_RATE", ratio(*METRICS))


def dataset_rate(reports: DataFrame, wanted: Sequence[str], cap: bool = False) -> DataFrame:
    """Actual over expected reports per district and month.

    The wide table is staged: which products exist and whether any doubled row is odd are questions about
    all of it that must be answered before its rows can be chosen.
    """
    wide = deduplicate_reports(chosen_products(stage(reports_wide(reports)), wanted))
    return district_rate(cap_reports(wide) if cap else wide)


def attach_rate(routine: DataFrame, rate: DataFrame) -> DataFrame:
    return routine.join(rate.select(*RATE_KEYS, "REPORTING_RATE"), list(RATE_KEYS), "left")


# --- data element method ----------------------------------------------------------------------------


def facility_months(pyramid: DataFrame, routine: DataFrame, activity: Sequence[str],
                    facility: DataFrame | None = None) -> DataFrame:
    """One row per facility and month: ACTIVE_THIS_PERIOD, ACTIVE_THIS_YEAR and OPEN as 0/1.

    Active = any activity indicator present and not negative. Open = by dates at the start of the month
    and no closing word in the name. A facility's active months are gathered as one array (as long as the
    calendar at most) before the only join, by facility; the months are then unfolded in place, so the
    facility x month grid is never shuffled. `facility` adds columns by OU_ID in the same join.
    """
    active = F.when(any_true([F.col(c) >= 0 for c in activity]), F.col("PERIOD"))
    seen = routine.groupBy("OU_ID").agg(F.collect_set(active).alias("_active"))
    extra = []
    if facility is not None:
        extra = [c for c in facility.columns if c != "OU_ID"]
        seen = seen.join(facility, "OU_ID", "full")
    units = pyramid.select(*ADMIN, "OU_ID", "OU_NAME", "OPENING_DATE", "CLOSED_DATE").distinct()
    df = with_every_month(units.join(seen, "OU_ID", "left"), routine)
    year = (F.col("PERIOD") / 100).cast("int")
    this_month = F.array_contains("_active", F.col("PERIOD"))
    this_year = F.exists("_active", lambda p: (p / 100).cast("int") == year)
    is_open = open_at_month_start("OPENING_DATE", "CLOSED_DATE", "PERIOD") & ~name_is_closed("OU_NAME")

    def zero_one(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    return df.select(*ADMIN, "OU_ID", "PERIOD", year.alias("YEAR"), zero_one(this_month).alias("ACTIVE_THIS_PERIOD"),
                     zero_one(this_year).alias("ACTIVE_THIS_YEAR"), zero_one(is_open).alias("OPEN"), *extra)


def facility_means(routine: DataFrame, volume: Sequence[str]) -> DataFrame:
    """Mean cases per month with cases; null when there is no such month."""
    total = row_sum(list(volume))
    return routine.select("ADM2_ID", "OU_ID", total.alias("t")).groupBy("ADM2_ID", "OU_ID").agg(
        ratio(F.sum("t"), F.count_if(F.col("t") > 0)).alias("MEAN_CASES"))


def facility_weights(routine: DataFrame, volume: Sequence[str]) -> DataFrame:
    """WEIGHT = mean / district sum of means x number of facilities in the district.

    Facilities without activity count in the number but have no weight. District totals are joined back
    instead of windowed, so a district with very many facilities is not gathered in one task.
    """
    means = facility_means(routine, volume)
    district = means.groupBy("ADM2_ID").agg(sum_zero("MEAN_CASES").alias("_sum"), F.count(F.lit(1)).alias("_hf"))
    return means.join(district, "ADM2_ID").select(
        "ADM2_ID", "OU_ID", "MEAN_CASES", (ratio("MEAN_CASES", "_sum") * F.col("_hf")).alias("WEIGHT"))


FLAGS = ("ACTIVE_THIS_PERIOD", "COUNT", "OPEN", "ACTIVE_THIS_YEAR")


def monthly_rates(months: DataFrame) -> DataFrame:
    """All reporting rates per district and month, plain and weighted, from months with a WEIGHT column."""
    df = months.withColumn("COUNT", F.lit(1))
    sums = df.groupBy(*ADMIN, "YEAR", "PERIOD").agg(
        *[F.sum(f).cast("double").alias(f) for f in FLAGS],
        *[sum_zero(F.col(f) * F.col("WEIGHT")).alias(f"{f}_W") for f in FLAGS],
    )
    rates = {}
    for tail in ("", "_W"):
        top = f"ACTIVE_THIS_PERIOD{tail}"
        rates[f"RR_TOTAL_HF{tail}"] = ratio(top, f"COUNT{tail}")
        rates[f"RR_OPEN_HF{tail}"] = ratio(top, f"OPEN{tail}")
        rates[f"RR_ACTIVE_HF{tail}"] = ratio(top, f"ACTIVE_THIS_YEAR{tail}")
    return sums.withColumns(rates)


def yearly_rates(months: DataFrame) -> DataFrame:
    facility = months.groupBy(*ADMIN, "OU_ID", "YEAR").agg(
        F.max("OPEN").alias("o"), F.max("ACTIVE_THIS_YEAR").alias("a"))
    sums = facility.groupBy(*ADMIN, "YEAR").agg(
        F.count(F.lit(1)).alias("NR_OF_HF"), F.sum("o").alias("NR_OF_OPEN_HF"), F.sum("a").alias("HF_ACTIVE"))
    return sums.withColumns({"RR_TOTAL_HF": ratio("HF_ACTIVE", "NR_OF_HF"),
                             "RR_OPEN_HF": ratio("HF_ACTIVE", "NR_OF_OPEN_HF")})


# Denominator choice to rate column.
RATE_COLUMN = {"ROUTINE_ACTIVE_FACILITIES": "RR_ACTIVE_HF", "PYRAMID_OPEN_FACILITIES": "RR_OPEN_HF"}


def chosen_rate(monthly: DataFrame, denominator: str, weighted: bool = False) -> DataFrame:
    column = RATE_COLUMN[denominator] + ("_W" if weighted else "")
    return monthly.select("ADM2_ID", "YEAR", (F.col("PERIOD") % 100).alias("MONTH"),
                          F.col(column).alias("REPORTING_RATE"))


def element_rate(pyramid: DataFrame, routine: DataFrame, activity: Sequence[str], volume: Sequence[str],
                 denominator: str = "ROUTINE_ACTIVE_FACILITIES", weighted: bool = False) -> DataFrame:
    weights = facility_weights(routine, volume).select("OU_ID", "WEIGHT")
    months = facility_months(pyramid, routine, activity, weights)
    return chosen_rate(monthly_rates(months), denominator, weighted)


# --- older method -----------------------------------------------------------------------------------


def submitted_reports(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    present = any_true([F.col(c).isNotNull() for c in indicators]).cast("int")
    return routine.groupBy(*RATE_KEYS).agg(F.sum(present).alias("SUBMITTED_REPORTS"))


def expected_from_routine(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Distinct facilities with any value in the year."""
    present = any_true([F.col(c).isNotNull() for c in indicators])
    return routine.filter(present).groupBy("ADM2_ID", "YEAR").agg(
        F.count_distinct("OU_ID").alias("EXPECTED_REPORTS"))


def expected_from_pyramid(pyramid: DataFrame, routine: DataFrame) -> DataFrame:
    """Facilities open at some time of each month; 0 where a district has none."""
    grid = with_every_month(pyramid.select("ADM2_ID").distinct(), routine)
    counts = open_per_month(pyramid.select("ADM2_ID", "OPENING_DATE", "CLOSED_DATE"), routine, grid, ["ADM2_ID"], "EXPECTED_REPORTS")
    return counts.select("ADM2_ID", year_of("PERIOD").alias("YEAR"), (F.col("PERIOD") % 100).alias("MONTH"), "EXPECTED_REPORTS")


def merge_facility_levels(hospitals: DataFrame, others: DataFrame) -> DataFrame:
    """Hospitals kept one level up join the other facilities in one list."""
    return hospitals.unionByName(others, allowMissingColumns=True).distinct()


def older_rate(routine: DataFrame, indicators: Sequence[str], expected: DataFrame) -> DataFrame:
    keys = [k for k in RATE_KEYS if k in expected.columns]
    return attach(submitted_reports(routine, indicators), expected, keys, ["EXPECTED_REPORTS"]).withColumn(
        "REPORTING_RATE", ratio("SUBMITTED_REPORTS", "EXPECTED_REPORTS"))


def yearly_mean_rate(rate: DataFrame, name: str = "REPORTING_RATE") -> DataFrame:
    """Mean monthly rate of each district and year."""
    return rate.groupBy("ADM2_ID", "YEAR").agg(F.avg("REPORTING_RATE").alias(name))
