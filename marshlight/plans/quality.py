"""Quality-of-care indicators per district and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import positive_ratio, sum_zero, to_num_blank
from ..operators.joins import attach

# rate = numerator / denominator.
RATIOS = {
    "testing_rate": ("TEST", "SUSP"),
    "treatment_rate": ("MALTREAT", "CONF"),
    "case_fatality_rate": ("MALDTH", "MALADM"),
    "prop_adm_malaria": ("MALADM", "ALLADM"),
    "prop_malaria_deaths": ("MALDTH", "ALLDTH"),
}
# Counts carried over under another name.
COUNTS = {"non_malaria_all_cause_outpatients": "ALLOUT", "presumed_cases": "PRES"}
INDICATORS = ("TEST", "SUSP", "MALTREAT", "CONF", "MALDTH", "MALADM", "ALLADM", "ALLDTH", "ALLOUT", "PRES")


def district_year_sums(routine: DataFrame, indicators: Sequence[str] = INDICATORS) -> DataFrame:
    cols = [c for c in indicators if c in routine.columns]
    keys = ["ADM2_ID", "YEAR"]
    if not cols:
        return routine.select(*keys).distinct()
    return routine.groupBy(*keys).agg(*[sum_zero(to_num_blank(c)).alias(c) for c in cols])


def quality_of_care(routine: DataFrame, names: DataFrame | None = None) -> DataFrame:
    df = district_year_sums(routine)
    out = {n: positive_ratio(a, b) for n, (a, b) in RATIOS.items() if a in df.columns and b in df.columns}
    out |= {n: F.col(c) for n, c in COUNTS.items() if c in df.columns}
    df = df.withColumns(out)
    return df if names is None else attach(df, names, ["ADM2_ID"])


def national_summary(quality: DataFrame) -> DataFrame:
    """Per year: mean of district rates, sum of counts."""
    aggs = [F.avg(c).alias(c) for c in RATIOS if c in quality.columns]
    aggs += [sum_zero(c).alias(c) for c in COUNTS if c in quality.columns]
    return quality.groupBy("YEAR").agg(*aggs)
