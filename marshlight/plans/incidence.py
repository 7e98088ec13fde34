"""Crude and adjusted malaria incidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import ratio, sum_poison, sum_zero
from ..operators.keys import first_per_key
from ..operators.shape import require

MONTH_KEYS = ("ADM1_ID", "ADM2_ID", "YEAR", "MONTH")


def choose_group(routine: DataFrame, group: str, method: str) -> DataFrame:
    """Use the columns of a population group (e.g. UNDER_5) for SUSP or PRES, TEST and CONF."""
    cols = ["TEST", "CONF", "PRES" if method == "PRES" else "SUSP"]
    require(routine, [f"{c}_{group}" for c in cols], f"routine data for {group}")
    return routine.withColumns({c: F.col(f"{c}_{group}") for c in cols})


def choose_population(population: DataFrame, group: str | None, fall_back: bool = False) -> DataFrame:
    """POPULATION of a group; a missing column fails unless `fall_back` keeps the whole population."""
    if group is None:
        return population
    column = f"POP_{group}"
    if fall_back and column not in population.columns:
        return population
    require(population, [column], "population")
    return population.withColumn("POPULATION", F.col(column))


def care_seeking(data: DataFrame, value: str) -> DataFrame:
    """CARESEEKING_PCT in percent: a column whose values are all at most 1 is a share.

    Text that is no number fails the job; of several values of one place the lowest known one counts.
    """
    key = "ADM2_ID" if "ADM2_ID" in data.columns else "ADM1_ID"
    require(data, [key, value], "care-seeking data")
    text = F.nullif(F.trim(F.col(value).cast("string")), F.lit(""))
    v = F.when(text.isNotNull(), F.coalesce(text.try_cast("double"), F.raise_error(
        F.concat(F.lit("care-seeking value is not a number: "), text)).cast("double")))
    top = data.agg(F.max(v).alias("top")).scalar()
    pct = F.when(top <= 1, v * 100).otherwise(v)
    return first_per_key(data.select(key, pct.alias("CARESEEKING_PCT")), [key], ["CARESEEKING_PCT"])


def positivity(conf: str = "CONF", test: str = "TEST") -> Column:
    """CONF / TEST, and 1 when nothing was tested or either is missing."""
    return F.when(F.col(conf).isNotNull() & (F.col(test) != 0), F.col(conf) / F.col(test)).otherwise(F.lit(1.0))


def monthly_cases(routine: DataFrame, rate: DataFrame, method: str = "PRES",
                  careseeking: DataFrame | None = None) -> DataFrame:
    """District cases per month with N1 (testing), N2 (reporting) and N3 (care-seeking) adjustments."""
    has_pres = "PRES" in routine.columns
    cases = ["CONF", "TEST", "SUSP"] + (["PRES"] if has_pres else [])
    df = routine.groupBy(*MONTH_KEYS).agg(*[sum_zero(c).alias(c) for c in cases])
    if method == "SUSP-TEST":
        df = df.withColumn("TEST", F.least("TEST", "SUSP"))
    df = df.join(rate.select("ADM2_ID", "YEAR", "MONTH", "REPORTING_RATE"), ["ADM2_ID", "YEAR", "MONTH"], "left")
    df = df.withColumn("TPR", positivity())
    presumed = F.col("PRES") if method == "PRES" and has_pres else F.col("SUSP") - F.col("TEST")
    df = df.withColumn("N1", F.col("CONF") + presumed * F.col("TPR"))
    df = df.withColumn("N2", ratio("N1", "REPORTING_RATE"))
    return df if careseeking is None else with_care_seeking(df, careseeking)


def with_care_seeking(cases: DataFrame, careseeking: DataFrame) -> DataFrame:
    """N3 = N2 / share seeking care; a district without data counts as 100 %."""
    key = "ADM2_ID" if "ADM2_ID" in careseeking.columns else "ADM1_ID"
    one = first_per_key(careseeking.select(key, "CARESEEKING_PCT"), [key], ["CARESEEKING_PCT"])
    df = cases.join(one, key, "left").withColumn("CARESEEKING_PCT", F.coalesce("CARESEEKING_PCT", F.lit(100.0)))
    return df.withColumn("N3", ratio("N2", F.col("CARESEEKING_PCT") / 100))


def with_sector_shares(cases: DataFrame, shares: DataFrame) -> DataFrame:
    """Older N3 from public, private and no care percentages by region."""
    df = cases.join(shares, "ADM1_ID", "left")
    return df.withColumn("N3", F.col("N2") + ratio(F.col("N2") * F.col("PCT_PRIVATE_CARE"), "PCT_PUBLIC_CARE")
                         + ratio(F.col("N2") * F.col("PCT_NO_CARE"), "PCT_PUBLIC_CARE"))


def with_plain_share(cases: DataFrame, shares: DataFrame) -> DataFrame:
    """Older N3 = N2 / PCT by region."""
    return cases.join(shares, "ADM1_ID", "left").withColumn("N3", ratio("N2", "PCT"))


# Output column to its case count.
RATES = {
    "INCIDENCE_CRUDE": "CONF",
    "INCIDENCE_ADJ_TESTING": "N1",
    "INCIDENCE_ADJ_REPORTING": "N2",
    "INCIDENCE_ADJ_CARESEEKING": "N3",
}


def yearly_incidence(cases: DataFrame, population: DataFrame) -> DataFrame:
    """Cases per 1000 people and year. One month without N2 leaves the year's N2 unknown; N3 skips such months."""
    sums = [sum_poison(c).alias(c) for c in ("CONF", "N1", "N2")]
    if "N3" in cases.columns:
        sums.append(sum_zero("N3").alias("N3"))
    df = cases.groupBy("ADM2_ID", "YEAR").agg(*sums)
    df = df.join(population.drop("ADM1_ID") if "ADM1_ID" in population.columns else population,
                 ["ADM2_ID", "YEAR"], "left")
    rates = {
        name: ratio(count, "POPULATION") * 1000 if count in df.columns else F.lit(None).cast("double")
        for name, count in RATES.items()
    }
    return df.withColumns(rates)


def incidence(routine: DataFrame, rate: DataFrame, population: DataFrame, method: str = "PRES",
              careseeking: DataFrame | None = None, group: str | None = None) -> DataFrame:
    if group is not None:
        routine = choose_group(routine, group, method)
    return yearly_incidence(monthly_cases(routine, rate, method, careseeking), choose_population(population, group))


# --- checks -----------------------------------------------------------------------------------------


def yearly_order_checks(yearly: DataFrame, pairs: Sequence[tuple[str, str]] = (
        ("INCIDENCE_CRUDE", "INCIDENCE_ADJ_TESTING"), ("INCIDENCE_ADJ_TESTING", "INCIDENCE_ADJ_REPORTING"),
        ("INCIDENCE_ADJ_REPORTING", "INCIDENCE_ADJ_CARESEEKING"))) -> DataFrame:
    """Number of rows where a later adjustment lies below the earlier one."""
    return yearly.agg(*[F.count_if(F.col(b) < F.col(a)).alias(f"{b}_below_{a}") for a, b in pairs])


def monthly_checks(cases: DataFrame) -> DataFrame:
    return cases.agg(
        F.count_if(F.col("CONF") > F.col("TEST")).alias("conf_above_test"),
        F.count_if(F.col("SUSP") < F.col("TEST")).alias("susp_below_test"),
        F.count_if(F.col("PRES") == 0).alias("pres_zero"),
        F.count_if(F.col("CONF") > F.col("N1")).alias("conf_above_n1"),
        F.count_if(F.col("N1") > F.col("N2")).alias("n1_above_n2"),
    )


def zero_rates(rate: DataFrame) -> DataFrame:
    zero = F.col("REPORTING_RATE") == 0
    return rate.agg(F.count_if(zero).alias("zero_months"),
                    F.count_distinct(F.when(zero, F.col("ADM2_ID"))).alias("zero_districts"))


def missing_rate_share(rate: DataFrame) -> DataFrame:
    return rate.groupBy("YEAR").agg(
        (F.count_if(F.col("REPORTING_RATE").isNull()) / F.count(F.lit(1)) * 100).alias("pct_missing"))


def yearly_positivity(cases: DataFrame) -> DataFrame:
    sums = cases.groupBy("ADM2_ID", "YEAR").agg(sum_zero("CONF").alias("CONF"), sum_zero("TEST").alias("TEST"))
    return sums.withColumn("TPR", positivity())
