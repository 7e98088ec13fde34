"""One results row per district from all other tables.

Every input is reduced to one row per district before its join, so the whole table is a chain of joins of
district-sized tables. A missing input is None and its layer is skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import update_columns

ADMIN = ("ADM1_NAME", "ADM1_ID", "ADM2_NAME", "ADM2_ID")
KEY = ("ADM2_ID",)
INCIDENCE = ("INCIDENCE_CRUDE", "INCIDENCE_ADJ_TESTING", "INCIDENCE_ADJ_REPORTING", "INCIDENCE_ADJ_CARESEEKING")

# Metric name to result column and factor.
METRICS = {
    "Pf_Parasite_Rate": ("PF_PR_RATE", 100),
    "Pf_Mortality_Rate": ("PF_MORTALITY_RATE", 100000),
    "Pf_Incidence_Rate": ("PF_INCIDENCE_RATE", 1000),
    "Insecticide_Treated_Net_Access": ("ITN_ACCESS_RATE", 100),
    "Insecticide_Treated_Net_Use_Rate": ("ITN_USE_RATE_RATE", 100),
    "IRS_Coverage": ("IRS_COVERAGE_RATE", 100),
    "Antimalarial_Effective_Treatment": ("ANTIMALARIAL_EFT_RATE", 100),
}


def empty_results(admin: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Distinct districts and one null column per variable of the metadata table."""
    return admin.select(*ADMIN).distinct().select(*ADMIN, *[F.lit(None).cast("double").alias(v) for v in variables])


def summary(c: Column | str, metric: str) -> Column:
    return F.median(c) if metric == "median" else F.avg(c)


def mean_rate(rate: DataFrame, metric: str = "mean") -> DataFrame:
    """Mean or median over all periods, in percent with one decimal."""
    return rate.groupBy(*KEY).agg(F.bround(summary("REPORTING_RATE", metric) * 100, 1).alias("REPORTING_RATE"))


def year_window(df: DataFrame, back: int) -> DataFrame:
    """All years for 0, the last n for -n; a window longer than the data is the whole data."""
    if back == 0:
        return df
    last = df.agg(F.max("YEAR")).scalar()
    return df.filter(F.col("YEAR") >= last + F.lit(back + 1))


def mean_incidence(incidence: DataFrame, metric: str = "mean", back: int = 0,
                   columns: Sequence[str] = INCIDENCE) -> DataFrame:
    cols = [c for c in columns if c in incidence.columns]
    return year_window(incidence, back).groupBy(*KEY).agg(*[summary(c, metric).alias(c) for c in cols])


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Scaled district means of the latest year of each metric, one column per metric."""
    means = metrics.filter("STATISTIC = 'MEAN'")
    latest = means.groupBy("METRIC_NAME").agg(F.max("YEAR").alias("YEAR"))
    rows = means.join(latest, ["METRIC_NAME", "YEAR"])
    return rows.groupBy(*KEY).agg(*[
        F.bround(F.max(F.when(F.col("METRIC_NAME") == name, F.col("VALUE"))) * factor, 2).alias(column)
        for name, (column, factor) in METRICS.items()
    ])


def season_label(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == 0, F.lit("not-seasonal")).when(c == 1, F.lit("seasonal"))


def add_population(results: DataFrame, population: DataFrame, year: int | None = None) -> DataFrame:
    """Population of `year`, by default the latest; extra group columns of the results follow it.

    A transformed population runs years ahead; its reference year is the one to give.
    """
    latest = population.filter(F.col("YEAR") == (population.agg(F.max("YEAR")).scalar() if year is None else year))
    cols = [c for c in population.columns if c in results.columns and (c == "POPULATION" or c.startswith("POP_"))]
    return update_columns(results, latest, KEY, cols)


def add_rate(results: DataFrame, rate: DataFrame, metric: str = "mean") -> DataFrame:
    return update_columns(results, mean_rate(rate, metric), KEY, ["REPORTING_RATE"], keep_old=False)


def add_incidence(results: DataFrame, incidence: DataFrame, metric: str = "mean", back: int = 0) -> DataFrame:
    cols = [c for c in INCIDENCE if c in incidence.columns and c in results.columns]
    return update_columns(results, mean_incidence(incidence, metric, back, cols), KEY, cols, keep_old=False,
                          rounding=2)


def add_metrics(results: DataFrame, metrics: DataFrame) -> DataFrame:
    cols = [c for c, _ in METRICS.values() if c in results.columns]
    return update_columns(results, latest_metrics(metrics), KEY, cols)


def add_seasonality(results: DataFrame, table: DataFrame, label: str) -> DataFrame:
    flag, block = f"SEASONALITY_{label}", f"SEASONAL_BLOCK_DURATION_{label}"
    new = table.select(*KEY, season_label(flag).alias(flag), F.col(block).cast("double").alias(block))
    return update_columns(results.withColumn(flag, F.col(flag).cast("string")), new, KEY, [flag, block])


def add_region_values(results: DataFrame, survey: DataFrame, columns: Mapping[str, str],
                      rounding: int = 2) -> DataFrame:
    """Survey values by region copied to every district of the region; missing replaces old."""
    new = survey.select("ADM1_ID", *[F.col(a).alias(b) for a, b in columns.items()])
    return update_columns(results, new, ["ADM1_ID"], list(columns.values()), keep_old=False, rounding=rounding)


def add_user_layer(results: DataFrame, layer: DataFrame) -> DataFrame:
    """Known columns of a user's table replace values where present; names and unknown columns are ignored."""
    cols = [c for c in layer.columns if c in results.columns and c not in ADMIN]
    typed = layer.select(*KEY, *[F.col(c).try_cast(results.schema[c].dataType.simpleString()).alias(c) for c in cols])
    return update_columns(results, typed, KEY, cols)


def assemble(admin: DataFrame, variables: Sequence[str], population: DataFrame | None = None,
             rate: DataFrame | None = None, incidence: DataFrame | None = None, metrics: DataFrame | None = None,
             rain: DataFrame | None = None, cases: DataFrame | None = None,
             surveys: Sequence[tuple[DataFrame, Mapping[str, str]]] = (), access: DataFrame | None = None,
             user_layer: DataFrame | None = None, rate_metric: str = "mean", incidence_metric: str = "mean",
             years_back: int = 0, population_year: int | None = None) -> DataFrame:
    out = empty_results(admin, variables)
    if population is not None:
        out = add_population(out, population, population_year)
    if rate is not None:
        out = add_rate(out, rate, rate_metric)
    if incidence is not None:
        out = add_incidence(out, incidence, incidence_metric, years_back)
    if metrics is not None:
        out = add_metrics(out, metrics)
    if rain is not None:
        out = add_seasonality(out, rain, "RAINFALL")
    if cases is not None:
        out = add_seasonality(out, cases, "CASES")
    for table, columns in surveys:
        out = add_region_values(out, table, columns)
    if access is not None:
        out = update_columns(out, access, KEY, ["PCT_HEALTH_ACCESS"])
    if user_layer is not None:
        out = add_user_layer(out, user_layer)
    return out


def periods_used(population: DataFrame | None = None, rate: DataFrame | None = None, incidence: DataFrame | None = None,
                 metrics: DataFrame | None = None, rain: DataFrame | None = None, cases: DataFrame | None = None,
                 years_back: int = 0, population_year: int | None = None) -> DataFrame:
    """VARIABLE and PERIOD (a year, or first-last) of what `assemble` takes from these tables; one row per variable.

    `rain` and `cases` are here the monthly series with a YEAR. Meant for `config.update_metadata`.
    """
    def span(df: DataFrame, variables: Sequence[str], one_year: bool = False) -> DataFrame:
        years = df.agg(F.min("YEAR").alias("a"), F.max("YEAR").alias("b"))
        text = F.when(F.lit(one_year) | (F.col("a") == F.col("b")), F.col("b").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
        return years.select(F.explode(F.array(*[F.lit(v) for v in variables])).alias("VARIABLE"), text.alias("PERIOD"))

    parts = []
    if population is not None:
        chosen = population if population_year is None else population.filter(F.col("YEAR") == population_year)
        parts.append(span(chosen, [c for c in population.columns if c == "POPULATION" or c.startswith("POP_")], one_year=True))
    if rate is not None:
        parts.append(span(rate, ["REPORTING_RATE"]))
    if incidence is not None:
        parts.append(span(year_window(incidence, years_back), [c for c in INCIDENCE if c in incidence.columns]))
    for table, label in ((rain, "RAINFALL"), (cases, "CASES")):
        if table is not None:
            parts.append(span(table, [f"SEASONALITY_{label}", f"SEASONAL_BLOCK_DURATION_{label}"]))
    if metrics is not None:
        names = F.create_map(*[F.lit(x) for k, (column, _) in METRICS.items() for x in (k, column)])
        latest = metrics.filter("STATISTIC = 'MEAN'").groupBy("METRIC_NAME").agg(F.max("YEAR").cast("string").alias("PERIOD"))
        parts.append(latest.select(F.try_element_at(names, F.col("METRIC_NAME")).alias("VARIABLE"), "PERIOD").filter("VARIABLE is not null"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
