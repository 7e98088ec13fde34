"""The tables behind data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_true, ratio, share, sum_poison
from ..functions.periods import months_between
from ..functions.text import facility_type
from ..operators.joins import open_years
from ..operators.quantiles import exact_quantiles
from ..operators.shape import long_form

# --- completeness -----------------------------------------------------------------------------------


def value_status(long: DataFrame) -> DataFrame:
    """Missing, zero and positive values per indicator and month over all facilities and months.

    The full grid is not built: cells with a value are counted, and the rest of facilities x months is
    missing by subtraction. A facility-month with any missing part is missing.
    """
    cells = long.groupBy("INDICATOR", "PERIOD", "OU_ID").agg(sum_poison("VALUE").alias("v"))
    seen = cells.groupBy("INDICATOR", "PERIOD").agg(
        F.count("v").alias("n_known"), F.count_if(F.col("v") == 0).alias("n_zero"),
        F.count_if(F.col("v") > 0).alias("n_positive"))
    n_units = long.agg(F.count_distinct("OU_ID").alias("n")).scalar()
    months = long.agg(F.array_sort(F.collect_set("PERIOD")).alias("m")).scalar()  # the calendar's length
    grid = long.select("INDICATOR").distinct().withColumn("_m", months).withColumn(
        "PERIOD", F.explode("_m")).drop("_m")
    df = grid.join(seen, ["INDICATOR", "PERIOD"], "left").fillna(0, ["n_known", "n_zero", "n_positive"])
    df = df.withColumn("n_total", n_units).withColumn("n_missing", F.col("n_total") - F.col("n_known"))
    return df.drop("n_known").withColumns(
        {f"pct_{k}": ratio(f"n_{k}", "n_total") * 100 for k in ("missing", "zero", "positive")})


def district_status(long: DataFrame) -> DataFrame:
    """Districts per indicator and month: nothing reported, only zeros, anything positive; numbers and percents.

    Of all districts, indicators and months; a district absent from a month is missing by subtraction.
    """
    per = long.groupBy("INDICATOR", "PERIOD", "ADM2_ID").agg(
        F.count("VALUE").alias("n"), F.max("VALUE").alias("top"), F.bool_and(F.col("VALUE") == 0).alias("zero"))
    known = F.col("n") > 0
    seen = per.groupBy("INDICATOR", "PERIOD").agg(
        F.count_if(known).alias("n_known"), F.count_if(known & F.col("zero")).alias("n_zero"),
        F.count_if(known & (F.col("top") > 0)).alias("n_positive"))
    n_units = long.agg(F.count_distinct("ADM2_ID").alias("n")).scalar()
    months = long.agg(F.array_sort(F.collect_set("PERIOD")).alias("m")).scalar()  # the calendar's length
    grid = long.select("INDICATOR").distinct().withColumn("PERIOD", F.explode(months))
    df = grid.join(seen, ["INDICATOR", "PERIOD"], "left").fillna(0, ["n_known", "n_zero", "n_positive"])
    df = df.withColumn("n_total", n_units).withColumn("n_missing", F.col("n_total") - F.col("n_known"))
    return df.drop("n_known").withColumns(
        {f"pct_{k}": ratio(f"n_{k}", "n_total") * 100 for k in ("missing", "zero", "positive")})


def facility_activity(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Per year: facilities that reported anything, and their share of all and of that year's facilities."""
    active = any_true([F.col(c).isNotNull() for c in indicators])
    per = routine.groupBy("OU_ID", "YEAR").agg(F.bool_or(active).alias("a"))
    total = routine.agg(F.count_distinct("OU_ID").alias("n")).scalar()
    by_year = per.groupBy("YEAR").agg(F.count_if("a").alias("n_active"), F.count(F.lit(1)).alias("n_listed"))
    return by_year.withColumns({"pct_of_all": F.col("n_active") / total * 100,
                                "pct_of_listed": ratio("n_active", "n_listed") * 100})


def ever_active(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    active = any_true([F.col(c).isNotNull() for c in indicators])
    per = routine.groupBy("OU_ID").agg(F.bool_or(active).alias("a"))
    return per.agg(F.count_if("a").alias("n_active"), F.count(F.lit(1)).alias("n_facilities")).withColumn(
        "pct_active", ratio("n_active", "n_facilities") * 100)


def monthly_activity(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    active = any_true([F.col(c).isNotNull() for c in indicators])
    return routine.filter(active).groupBy("PERIOD").agg(F.count_distinct("OU_ID").alias("n_active"))


def monthly_reporting(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Reporting facilities per month, in percent of those ever active and of those active in the year."""
    active = any_true([F.col(c).isNotNull() for c in indicators])
    per = routine.groupBy("OU_ID", "YEAR", "PERIOD").agg(F.bool_or(active).alias("a"))
    ever = per.agg(F.count_distinct(F.when(F.col("a"), F.col("OU_ID"))).alias("n")).scalar()
    in_year = per.groupBy("YEAR").agg(F.count_distinct(F.when(F.col("a"), F.col("OU_ID"))).alias("n_active_year"))
    months = per.groupBy("YEAR", "PERIOD").agg(F.count_if("a").alias("n_reporting"))
    return months.join(in_year, "YEAR").withColumn("n_active_ever", ever).withColumns({
        "pct_of_ever": ratio("n_reporting", "n_active_ever") * 100, "pct_of_year": ratio("n_reporting", "n_active_year") * 100})


def opened_and_reporting(facilities: DataFrame, routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    active = any_true([F.col(c).isNotNull() for c in indicators])
    years = routine.select("YEAR").distinct()
    reporting = routine.filter(active).groupBy("YEAR").agg(F.count_distinct("OU_ID").alias("n_reporting"))
    return open_years(facilities, years).join(reporting, "YEAR", "left").fillna(0, ["n_reporting"]).withColumn(
        "pct_reporting", ratio("n_reporting", "n_open") * 100)


def element_coverage(raw: DataFrame, unit: str = "OU", period: str = "PE", element: str = "DX") -> DataFrame:
    """Share of months with a value per facility and element, and the facility's mean share.

    An element listed without any value counts with 0 months.
    """
    n_months = raw.agg(F.count_distinct(period).alias("n")).scalar()
    per = raw.groupBy(unit, element).agg(
        F.count_distinct(F.when(F.col("VALUE").isNotNull(), F.col(period))).alias("n_months"))
    per = per.withColumn("coverage", F.col("n_months") / n_months)
    overall = per.groupBy(unit).agg(F.avg("coverage").alias("unit_coverage"))
    return per.join(overall, unit)


def types_with_total(facilities: DataFrame, name: str = "OU_NAME") -> DataFrame:
    typed = facilities.select(facility_type(name).alias("type"))
    return typed.rollup("type").agg(F.count(F.lit(1)).alias("n")).select(
        F.coalesce("type", F.lit("Total")).alias("type"), "n")


def units_per_level(pyramid: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Distinct ids of each level column with its role."""
    counts = pyramid.agg(*[F.count_distinct(c).alias(c) for c in roles])
    long = counts.unpivot([], list(roles), "level", "n_units")
    labels = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv])
    return long.withColumn("role", F.try_element_at(labels, F.col("level")))


def categories_per_element(raw: DataFrame) -> DataFrame:
    """The set of categories is a codebook entry, not data: it stays small however many rows there are."""
    return raw.select("DX", "CO").distinct().groupBy("DX").agg(
        F.array_join(F.array_sort(F.collect_set("CO")), "; ").alias("categories"))


# --- coherence --------------------------------------------------------------------------------------

# Pairs where the first is expected to be at least the second, with report labels.
COHERENCE = {
    "allout_susp": ("ALLOUT", "SUSP", "Ambulatoire >= Suspects"),
    "allout_test": ("ALLOUT", "TEST", "Ambulatoire >= Testes"),
    "susp_test": ("SUSP", "TEST", "Suspects >= Testes"),
    "test_conf": ("TEST", "CONF", "Testes >= Confirmes"),
    "conf_treat": ("CONF", "MALTREAT", "Confirmes >= Traites"),
    "adm_dth": ("MALADM", "MALDTH", "Admissions Palu >= Deces Palu"),
}


def _checks(df: DataFrame) -> dict:
    return {n: share(F.col(a) >= F.col(b)).alias(f"pct_coherent_{n}")
            for n, (a, b, _) in COHERENCE.items() if a in df.columns and b in df.columns}


def national_coherence(routine: DataFrame) -> DataFrame:
    """Percent of a year's rows where the expected order holds, long form with labels."""
    checks = _checks(routine)
    wide = routine.groupBy("YEAR").agg(*checks.values())
    long = wide.unpivot(["YEAR"], [f"pct_coherent_{n}" for n in checks], "check_type", "pct_coherent")
    labelled = _with_labels(long.filter("pct_coherent is not null"))
    return labelled.withColumn("check_type", F.regexp_replace("check_type", "^pct_coherent_", ""))


def district_coherence(routine: DataFrame, min_reports: int = 5,
                       keys: Sequence[str] = ("ADM1_NAME", "ADM2_NAME", "ADM2_ID", "YEAR")) -> DataFrame:
    checks = _checks(routine)
    wide = routine.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_reports"), *checks.values())
    wide = wide.filter(F.col("total_reports") >= min_reports)
    long = wide.unpivot([*keys, "total_reports"], [f"pct_coherent_{n}" for n in checks], "check_type",
                        "pct_coherent")
    return _with_labels(long.filter("pct_coherent is not null"))


def _with_labels(long: DataFrame) -> DataFrame:
    labels = F.create_map(*[F.lit(x) for n, (_, _, text) in COHERENCE.items() for x in (f"pct_coherent_{n}", text)])
    return long.withColumn("check_label", F.try_element_at(labels, F.col("check_type")))


def scatter_stats(df: DataFrame, x: str, y: str, prob: float = 0.999) -> DataFrame:
    """Percent of rows with y > x, the pooled quantile of both columns, and the percent beyond it.

    Percents are of all rows, also those with a missing value; they have 2 and 3 decimals.
    """
    pooled = df.select(F.explode(F.array(F.col(x).cast("double"), F.col(y).cast("double"))).alias("v"))
    limit = exact_quantiles(pooled, "v", [prob]).select("quantile").scalar()
    beyond = (F.col(x) > F.col("limit")) | (F.col(y) > F.col("limit"))
    percent = lambda cond, digits: F.bround(ratio(F.count_if(cond), F.count(F.lit(1))) * 100, digits)
    return df.withColumn("limit", limit).agg(
        F.count(F.lit(1)).alias("n_points"), percent(F.col(y) > F.col(x), 2).alias("pct_above"),
        F.max("limit").alias("limit"), percent(beyond, 3).alias("pct_beyond"))


# --- trends -----------------------------------------------------------------------------------------


def element_months(raw: DataFrame, element: str = "INDICATOR", period: str = "PERIOD") -> DataFrame:
    """Monthly totals per element; months without data between its own first and last are 0."""
    sums = raw.groupBy(element, period).agg(F.sum("VALUE").alias("VALUE"))
    span = sums.groupBy(element).agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    grid = span.select(element, F.explode(months_between(F.col("lo"), F.col("hi"))).alias(period))
    return grid.join(sums, [element, period], "left").withColumn("VALUE", F.coalesce("VALUE", F.lit(0.0)))


def national_months(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    return routine.groupBy("PERIOD").agg(*[F.sum(c).alias(c) for c in indicators])


def group_shares(routine: DataFrame, parts: Sequence[str], keys: Sequence[str] = ("ADM2_ID",)) -> DataFrame:
    """District sums of disaggregated columns and each one's share of their total."""
    wide = routine.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in parts])
    total = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    long = long_form(wide.withColumn("_total", total), [*keys, "_total"], parts, "GROUP", "VALUE")
    return long.withColumn("SHARE", ratio("VALUE", "_total") * 100).drop("_total")


def annual_sums(monthly: DataFrame, value: str = "MEAN") -> DataFrame:
    return monthly.groupBy("ADM2_ID", "YEAR").agg(F.sum(value).alias("ANNUAL"))


# --- class breaks -----------------------------------------------------------------------------------


def equal_frequency_breaks(df: DataFrame, value: str, n: int) -> DataFrame:
    """Quantile breaks (n + 1 rows)."""
    return exact_quantiles(df, value, [i / n for i in range(n + 1)]).select("prob", F.col("quantile").alias("break"))


MOST_VALUES = 4096  # weighted values on which classes are chosen


def best_classes(values: np.ndarray, counts: np.ndarray, n: int) -> list[int]:
    """Ends (exclusive) of `n` classes of ascending values with the least sum of squares around their means.

    Dynamic programming over the classes: the best cost of the first j values in k classes follows from that of k - 1.
    """
    size = len(values)
    n = min(n, size)
    values = values - values.mean()  # sums of squares keep their digits
    total, first, second = (np.concatenate([[0.0], np.cumsum(counts * values**p)]) for p in (0, 1, 2))

    def within(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        rows = total[j] - total[i]
        return second[j] - second[i] - (first[j] - first[i]) ** 2 / np.where(rows > 0, rows, 1)

    ends = np.arange(size + 1)
    cost = np.where(ends > 0, within(np.zeros_like(ends), ends), np.inf)
    cuts = []
    for _ in range(n - 1):
        best, cut = np.full(size + 1, np.inf), np.zeros(size + 1, dtype=int)
        for a in range(1, size + 1, 256):
            j = np.arange(a, min(a + 256, size + 1))[:, None]
            i = np.arange(j[-1, 0])[None, :]
            whole = np.where(i < j, cost[i] + within(i, np.maximum(i, j)), np.inf)
            cut[j[:, 0]] = whole.argmin(axis=1)
            best[j[:, 0]] = whole.min(axis=1)
        cost = best
        cuts.append(cut)
    out = [size]
    for cut in reversed(cuts):
        out.insert(0, int(cut[out[0]]))
    return out


def k_means_breaks(df: DataFrame, value: str, n: int) -> list[float]:
    """Minimum, midpoints between the means of the `n` best classes, maximum. Runs a job.

    Classes have the least possible sum of squares, so results do not depend on a start. They are chosen on counts of values, at most
    MOST_VALUES of them: with more distinct values, on as many equal steps of the range, each at the mean of its values. With
    fewer distinct values than classes each value is a class; without values there are no breaks.
    """
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(value).cast("double").alias("v"))
    counts = known.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("distinct")).first()
    if not ends["distinct"]:
        return []
    step = F.col("v") if ends["distinct"] <= MOST_VALUES else F.least(
        F.floor((F.col("v") - ends["lo"]) / (ends["hi"] - ends["lo"]) * MOST_VALUES), F.lit(MOST_VALUES - 1))
    rows = counts.groupBy(step.alias("step")).agg(F.sum("n").alias("n"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v")).orderBy("v").collect()
    values, weights = np.array([r["v"] for r in rows]), np.array([r["n"] for r in rows], dtype=float)
    classes = best_classes(values, weights, n)
    centres = [float(np.average(values[a:b], weights=weights[a:b])) for a, b in zip([0, *classes], classes)]
    return [ends["lo"], *[(a + b) / 2 for a, b in zip(centres, centres[1:])], ends["hi"]]


def rounded_breaks(breaks: Sequence[float]) -> list[float]:
    """Upper breaks rounded to one digit below the leading one of the largest."""
    from math import floor, log10

    unit = 10 ** (floor(log10(max(breaks))) - 1)
    return [round(b / unit) * unit for b in breaks[1:]]
