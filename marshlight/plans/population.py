"""Population scaling, projection and group sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import round_even

ADMIN = ("ADM1_NAME", "ADM1_ID", "ADM2_NAME", "ADM2_ID")


def reference_year(population: DataFrame, year: int | None = None) -> Column:
    """The given year if the data has it, else the latest; a scalar subquery."""
    latest = F.max("YEAR")
    if year is None:
        return population.agg(latest.alias("y")).scalar()
    return population.agg(
        F.when(F.count_if(F.col("YEAR") == year) > 0, F.lit(year)).otherwise(latest).alias("y")).scalar()


def scale_to_reference(population: DataFrame, reference: float, year: int | None = None,
                       column: str = "POPULATION") -> DataFrame:
    """Multiply by (total of the reference year / reference). This is the factor in use, not its inverse."""
    total = population.filter(F.col("YEAR") == reference_year(population, year)).agg(F.sum(column).alias("t")).scalar()
    return population.withColumn(column, round_even(F.col(column) * (total / F.lit(float(reference)))).cast("int"))


def add_groups(population: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    return population.withColumns({n: round_even(F.col("POPULATION") * p) for n, p in shares.items()})


def add_district_groups(population: DataFrame, shares: DataFrame) -> DataFrame:
    """Group sizes from district shares. A share column without any value leaves the population table as it is.

    Whether a column is blank is data, so it is decided inside the plan by a scalar count.
    """
    cols = [c for c in shares.columns if c not in ADMIN]
    typed = shares.select("ADM2_ID", *[F.col(c).cast("string").try_cast("double").alias(f"_s_{c}") for c in cols])
    joined = population.join(typed, "ADM2_ID", "left")
    out = {}
    for c in cols:
        filled = typed.agg(F.count(f"_s_{c}").alias("n")).scalar()
        old = F.col(c).cast("double") if c in population.columns else F.lit(None).cast("double")
        out[c] = F.when(filled > 0, round_even(F.col("POPULATION") * F.col(f"_s_{c}"))).otherwise(old)
    return joined.withColumns(out).drop(*[f"_s_{c}" for c in cols])


def projected(value: Column, growth: float, steps: Column) -> Column:
    """Growth applied year by year, forward for positive steps, backward for negative, rounded each year."""
    years = F.when(F.abs(steps) >= 1, F.sequence(F.lit(1), F.greatest(F.abs(steps), F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    factor = F.lit(1.0 + growth)
    return F.aggregate(years, value.cast("double"), lambda acc, _: F.when(
        steps > 0, round_even(acc * factor)).otherwise(round_even(acc / factor)))


def project(population: DataFrame, growth: float, columns: Sequence[str] = ("POPULATION",), back: int = 6,
            forward: int = 6, year: int | None = None) -> DataFrame:
    """Reference year, `back` years before it and `forward` years after it, one row per district and year.

    Each reference row explodes into its years in place: no join, no shuffle.
    """
    base = population.filter(F.col("YEAR") == reference_year(population, year))
    df = base.withColumn("_k", F.explode(F.sequence(F.lit(-back), F.lit(forward))))
    values = {c: projected(F.col(c), growth, F.col("_k")) for c in columns}
    return df.withColumns({**values, "YEAR": F.col("YEAR") + F.col("_k")}).drop("_k")


def totals_by_year(population: DataFrame, columns: Sequence[str] = ("POPULATION",)) -> DataFrame:
    return population.groupBy("YEAR").agg(*[F.sum(c).alias(c) for c in columns])


def transform(population: DataFrame, reference: float | None, year: int | None, shares: Mapping[str, float],
              growth: float | None) -> DataFrame:
    df = population if reference is None else scale_to_reference(population, reference, year)
    df = add_groups(df, shares)
    return df if growth is None else project(df, growth, ["POPULATION", *shares], year=year)


def compare_sources(a: DataFrame, b: DataFrame, year: int) -> DataFrame:
    """District populations of two sources side by side; a year outside a source's range takes its nearest end."""
    def at(df: DataFrame, name: str) -> DataFrame:
        span = df.agg(F.greatest(F.min("YEAR"), F.least(F.max("YEAR"), F.lit(year))).alias("y")).scalar()
        return df.filter(F.col("YEAR") == span).groupBy("ADM2_ID").agg(F.sum("POPULATION").alias(name))

    df = at(a, "POP_A").join(at(b, "POP_B"), "ADM2_ID", "left")
    diff = F.col("POP_B") - F.col("POP_A")
    return df.withColumns({"DIFF": diff, "RATIO": F.try_divide("POP_B", "POP_A"),
                           "REL_DIFF": F.try_divide(diff, F.col("POP_A"))})
