"""Household-survey indicators by region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_true, ratio, row_sum
from ..operators.survey import domain_means, indicator_table, percent_interval, under_five_mortality

HOUSEHOLD = ("HHID", "HV000", "HV001", "HV002")


def with_weight(df: DataFrame, raw: str) -> DataFrame:
    return df.withColumn("wt", F.col(raw) / 1e6)


def code_is(c: str, *codes: int) -> Column:
    return F.coalesce(F.col(c).isin(*codes), F.lit(False))


# --- nets -------------------------------------------------------------------------------------------


def net_capacity(households: DataFrame, net_cols: Sequence[str], size: str = "HV013") -> DataFrame:
    """Two users per treated net, at most the household size; a missing size does not limit."""
    return households.withColumn("potential_users", F.least(2 * row_sum(list(net_cols)), F.col(size).cast("double")))


def net_access(households: DataFrame, persons: DataFrame, net_cols: Sequence[str], slept: str = "HV103",
               key: Sequence[str] = HOUSEHOLD) -> DataFrame:
    """Potential users / people who slept there; households where nobody slept are dropped.

    The ratio can exceed 1: potential users are limited by household size, not by sleepers.
    """
    nights = persons.groupBy(*key).agg(F.coalesce(F.sum(slept), F.lit(0)).alias("total_slept"))
    df = net_capacity(households, net_cols).join(nights, list(key), "left").filter("total_slept > 0")
    return df.withColumn("PCT_ITN_ACCESS", ratio("potential_users", "total_slept"))


def net_use(households: DataFrame, persons: DataFrame, slept: str = "HV103", net: str = "HML12",
            key: Sequence[str] = HOUSEHOLD) -> DataFrame:
    """Sleepers under a treated net / sleepers (net codes 1 and 2), by household."""
    under = F.when(F.col(slept).isNotNull(), ((F.col(slept) == 1) & code_is(net, 1, 2)).cast("int"))
    sums = persons.groupBy(*key).agg(F.coalesce(F.sum(slept), F.lit(0)).alias("total_slept"),
                                     F.coalesce(F.sum(under), F.lit(0)).alias("total_slept_itn"))
    sums = sums.withColumn("PCT_ITN_USE", ratio("total_slept_itn", "total_slept"))
    return households.join(sums, list(key))


# --- care-seeking -----------------------------------------------------------------------------------


def fever_children(kids: DataFrame) -> DataFrame:
    """Living children under 60 months with fever in the last two weeks."""
    return kids.filter((F.col("B5") == 1) & (F.col("B19") < 60) & (F.col("H22") == 1))


def care_flags(kids: DataFrame, public: Sequence[str], private: Sequence[str]) -> DataFrame:
    pub = any_true([F.col(c) == 1 for c in public])
    priv = any_true([F.col(c) == 1 for c in private])
    return kids.withColumns({"PCT_PUBLIC_CARE": pub.cast("int"), "PCT_PRIVATE_CARE": priv.cast("int"),
                             "PCT_NO_CARE": (~pub & ~priv).cast("int")})


def care_summary(kids: DataFrame, admin: DataFrame, flags: Sequence[str] = (
        "PCT_PUBLIC_CARE", "PCT_PRIVATE_CARE", "PCT_NO_CARE"), **design: str) -> DataFrame:
    """One row per region with an estimate for all flags; regions without one are left out."""
    table = indicator_table(kids, flags, admin, how="inner", **design)
    renamed = {f"{f}_SAMPLE_AVERAGE": f for f in flags}
    return table.select(*admin.columns, *[F.col(a).alias(b) for a, b in renamed.items()])


# --- prevalence -------------------------------------------------------------------------------------


def tested_children(persons: DataFrame) -> DataFrame:
    """Children of 6-59 months who slept here, in households chosen for testing."""
    return persons.filter(F.col("HC1").between(6, 59) & (F.col("HV103") == 1) & (F.col("HV042") == 1))


def test_result(df: DataFrame, source: str, name: str) -> DataFrame:
    """Result codes other than 0 and 1 are unknown."""
    return df.withColumn(name, F.when(F.col(source).isin(0, 1), F.col(source)))


# --- vaccination ------------------------------------------------------------------------------------


def vaccination_children(kids: DataFrame) -> DataFrame:
    return kids.filter((F.col("B5") == 1) & (F.col("B8") >= 1) & (F.col("B19") < 36))


def dose_flags(kids: DataFrame, sources: Sequence[str] = ("H3", "H5", "H7")) -> DataFrame:
    """DTP1-3: code 0 is no, 1-3 yes, else unknown; a later dose implies the earlier ones."""
    names = [f"DTP{i}" for i in range(1, len(sources) + 1)]
    raw = {n: F.when(F.col(s) == 0, F.lit(0)).when(F.col(s).isin(1, 2, 3), F.lit(1)) for n, s in zip(names, sources)}
    df = kids.withColumns(raw)
    for i in range(len(names) - 2, -1, -1):
        later = any_true([F.col(n) == 1 for n in names[i + 1:]])
        df = df.withColumn(names[i], F.when(later, F.lit(1)).otherwise(F.col(names[i])))
    return df


def dropout(table: DataFrame, pairs: Sequence[tuple[str, str]] = (
        ("DTP1", "DTP2"), ("DTP2", "DTP3"), ("DTP1", "DTP3"))) -> DataFrame:
    """Percent of children with dose a who lack dose b, from coverage averages."""
    out = {
        f"DROPOUT_{a}_{b}": (1 - ratio(f"{b}_SAMPLE_AVERAGE", f"{a}_SAMPLE_AVERAGE")) * 100 for a, b in pairs
    }
    return table.withColumns(out)


def mortality_table(births: DataFrame, labels: DataFrame, admin: DataFrame, window: int = 120) -> DataFrame:
    """Under-five deaths per 1000 by region name; only regions found in both tables."""
    rates = under_five_mortality(births, window=window).withColumnRenamed("V024", "DHS_ADM1_CODE")
    named = rates.join(labels, "DHS_ADM1_CODE")
    return admin.join(named.select("ADM1_NAME", F.col("R").alias("U5MR_SAMPLE_AVERAGE"),
                                   F.col("LCI").alias("U5MR_CI_LOWER_BOUND"),
                                   F.col("UCI").alias("U5MR_CI_UPPER_BOUND")), "ADM1_NAME")


__all__ = [
    "care_flags", "care_summary", "domain_means", "dose_flags", "dropout", "fever_children", "indicator_table",
    "mortality_table", "net_access", "net_capacity", "net_use", "percent_interval", "test_result",
    "tested_children", "vaccination_children", "with_weight",
]
