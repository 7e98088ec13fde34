"""Seasonality of cases and rainfall by district."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import ratio
from ..operators.models import fill_gaps
from ..operators.series import forward_sum
from ..operators.shape import with_every_month
from ..sources.staging import stage

DURATIONS = (3, 4, 5)
UNIT, YEAR, MONTH = "ADM2_ID", "YEAR", "MONTH"


def _calendar_year_total(value: str) -> Column:
    return F.coalesce(F.sum(value).over(Window.partitionBy(UNIT, YEAR)), F.lit(0.0))


def month_blocks(df: DataFrame, value: str, durations: Sequence[int] = DURATIONS, threshold: float = 0.6,
                 calendar_year: bool = False) -> DataFrame:
    """SUM_nM, SHARE_nM and FLAG_nM per district and month.

    A block is this month and the next n - 1; its share is of the next 12 months, or of the calendar year.
    """
    order = (YEAR, MONTH)
    total = _calendar_year_total(value) if calendar_year else forward_sum(value, 12, UNIT, order)
    df = df.withColumn("TOTAL_12M", total)
    for n in durations:
        df = df.withColumn(f"SUM_{n}M", forward_sum(value, n, UNIT, order))
        df = df.withColumn(f"SHARE_{n}M", F.when(F.col("TOTAL_12M") > 0, F.col(f"SUM_{n}M") / F.col("TOTAL_12M")))
        # three-valued: no total gives 0, a short window stays unknown
        hit = (F.col("TOTAL_12M") > 0) & (F.col(f"SHARE_{n}M") >= threshold)
        df = df.withColumn(f"FLAG_{n}M", hit.cast("int"))
    return df


def block_percentage(df: DataFrame, value: str, durations: Sequence[int] = DURATIONS,
                     threshold: float = 60) -> DataFrame:
    """Percent of the calendar year's total in the next n months, and whether it reaches `threshold` percent."""
    df = df.withColumn("TOTAL_YEAR", _calendar_year_total(value))
    for n in durations:
        df = df.withColumn(f"SUM_{n}M", forward_sum(value, n, UNIT, (YEAR, MONTH)))
        pct = F.when(F.col("TOTAL_YEAR") > 0, F.col(f"SUM_{n}M") * 100 / F.col("TOTAL_YEAR"))
        df = df.withColumn(f"PCT_{n}M", pct)
        df = df.withColumn(f"REACHED_{n}M", ((F.col("TOTAL_YEAR") > 0) & (F.col(f"PCT_{n}M") >= threshold)).cast("int"))
    return df


def seasonal_districts(blocks: DataFrame, durations: Sequence[int] = DURATIONS, threshold: float = 0.5) -> DataFrame:
    """SEASONAL_n per district: 1 if some calendar month starts a seasonal block in enough of its years.

    A district without a complete block for one of the durations is left out.
    """
    by_month = blocks.groupBy(UNIT, MONTH).agg(*[
        ratio(F.sum(f"FLAG_{n}M"), F.count_distinct(F.when(F.col(f"FLAG_{n}M").isNotNull(), F.col(YEAR))))
        .alias(f"P_{n}") for n in durations])
    flags = by_month.groupBy(UNIT).agg(*[
        F.max((F.col(f"P_{n}") >= threshold).cast("int")).alias(f"SEASONAL_{n}") for n in durations])
    return flags.dropna(subset=[f"SEASONAL_{n}" for n in durations])


def smallest_block(flags: DataFrame, durations: Sequence[int] = DURATIONS) -> DataFrame:
    """Shortest seasonal block (null if none) and overall 0/1."""
    hits = [F.when(F.col(f"SEASONAL_{n}") == 1, F.lit(n)) for n in durations]
    block = F.least(*hits) if len(hits) > 1 else hits[0]
    any_hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"SEASONAL_{n}") == 1, F.lit(False)) for n in durations])
    return flags.withColumns({"BLOCK": block, "SEASONALITY": any_hit.cast("int")})


def _block_rows(blocks: DataFrame, districts: DataFrame, durations: Sequence[int]) -> DataFrame:
    """District-months with the sum and flag of the district's own block length."""
    chosen = districts.filter("BLOCK is not null").select(UNIT, "BLOCK")
    df = blocks.join(chosen, UNIT)

    def pick(kind: str) -> Column:
        return F.coalesce(*[F.when(F.col("BLOCK") == n, F.col(f"{kind}_{n}M")) for n in durations])

    return df.select(UNIT, YEAR, MONTH, pick("SUM").alias("block_sum"), pick("FLAG").alias("block_flag"))


def season_share(blocks: DataFrame, districts: DataFrame, value: str,
                 durations: Sequence[int] = DURATIONS) -> DataFrame:
    """Mean over years of (largest block of the year / total of the year)."""
    best = _block_rows(blocks, districts, durations).groupBy(UNIT, YEAR).agg(F.max("block_sum").alias("best"))
    annual = blocks.groupBy(UNIT, YEAR).agg(F.sum(value).alias("annual")).filter("annual > 0")
    joined = best.filter("best is not null").join(annual, [UNIT, YEAR])
    return joined.groupBy(UNIT).agg(F.avg(F.col("best") / F.col("annual")).alias("PROPORTION"))


def start_month(blocks: DataFrame, districts: DataFrame, durations: Sequence[int] = DURATIONS,
                first_of_year: bool = False) -> DataFrame:
    """Most frequent flagged month (lowest on ties); with `first_of_year` only each year's first one counts."""
    rows = _block_rows(blocks, districts, durations).filter("block_flag = 1")
    if first_of_year:
        rows = rows.groupBy(UNIT, YEAR).agg(F.min(MONTH).alias(MONTH))
    return rows.groupBy(UNIT).agg(F.mode(MONTH, True).alias("START_MONTH"))


def seasonality(series: DataFrame, value: str, label: str, share_name: str, rainfall: bool = False,
                threshold: float = 0.6, year_share: float = 0.5, durations: Sequence[int] = DURATIONS) -> DataFrame:
    """One row per district: seasonal or not, block length, start month, share of the year in the block.

    Same rules as the functions above, in one pass: the blocks of a district are gathered in one row (as
    long as the calendar) by the partitioning their windows have, and all measures are taken from that array.
    """
    blocks = month_blocks(series, value, durations, threshold)
    fields = [YEAR, MONTH, F.col(value).alias("v"), *[c for n in durations for c in (f"SUM_{n}M", f"FLAG_{n}M")]]
    rows = blocks.groupBy(UNIT).agg(F.collect_list(F.struct(*fields)).alias("rows"))

    def seasonal(n: int) -> Column:
        flag = f"FLAG_{n}M"

        def of_month(m: Column) -> Column:
            known = F.filter("rows", lambda r: (r[MONTH] == m) & r[flag].isNotNull())
            years = F.size(F.array_distinct(F.transform(known, lambda r: r[YEAR])))
            return (ratio(F.size(F.filter(known, lambda r: r[flag] == 1)), years) >= year_share).cast("int")

        return F.array_max(F.transform(F.sequence(F.lit(1), F.lit(12)), of_month))

    flags = rows.withColumns({f"SEASONAL_{n}": seasonal(n) for n in durations})
    chosen = smallest_block(flags.dropna(subset=[f"SEASONAL_{n}" for n in durations]), durations)

    def pick(r: Column, kind: str) -> Column:
        return F.coalesce(*[F.when(F.col("BLOCK") == n, r[f"{kind}_{n}M"]) for n in durations])

    years = F.array_distinct(F.transform("rows", lambda r: r[YEAR]))
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def of_year(y: Column) -> Column:
        own = F.filter("rows", lambda r: r[YEAR] == y)
        return F.struct(
            F.array_max(F.transform(own, lambda r: pick(r, "SUM"))).cast("double").alias("best"),
            add(F.filter(F.transform(own, lambda r: r["v"].cast("double")), lambda x: x.isNotNull())).alias("annual"),
            F.array_min(F.transform(F.filter(own, lambda r: pick(r, "FLAG") == 1), lambda r: r[MONTH])).alias("first"))

    out = chosen.withColumn("years", F.transform(years, of_year))
    counted = F.filter("years", lambda y: y["best"].isNotNull() & (y["annual"] > 0))
    share = ratio(add(F.transform(counted, lambda y: y["best"] / y["annual"])), F.size(counted))
    starts = (F.transform("years", lambda y: y["first"]) if rainfall
              else F.transform(F.filter("rows", lambda r: pick(r, "FLAG") == 1), lambda r: r[MONTH]))
    votes = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.struct(
        F.size(F.filter("starts", lambda s: s == m)).alias("n"), (-m).alias("m")))
    best = F.array_max("votes")
    return out.withColumn("starts", starts).withColumn("votes", votes).select(
        UNIT,
        F.col("SEASONALITY").alias(f"SEASONALITY_{label}"),
        F.col("BLOCK").alias(f"SEASONAL_BLOCK_DURATION_{label}"),
        F.when(best["n"] > 0, -best["m"]).alias(f"SEASONAL_BLOCK_START_MONTH_{label}"),
        share.alias(share_name),
    )


def district_months(routine: DataFrame, value: str) -> DataFrame:
    """Monthly district sums on the full grid, missing months null."""
    sums = routine.groupBy(UNIT, "PERIOD").agg(F.sum(value).alias(value))
    grid = with_every_month(routine.select(UNIT).distinct(), routine)
    df = grid.join(sums, [UNIT, "PERIOD"], "left")
    return df.withColumns({YEAR: (F.col("PERIOD") / 100).cast("int"), MONTH: F.col("PERIOD") % 100})


def readiness(series: DataFrame, value: str, min_months: int, max_missing: float = 0.10,
              max_missing_unit: float = 0.20) -> DataFrame:
    """One row: enough months, few enough missing values overall and in every district."""
    missing = F.col(value).isNull().cast("double")
    per_unit = series.groupBy(UNIT).agg(F.avg(missing).alias("share"), F.sum(missing).alias("gone"),
                                        F.count(F.lit(1)).alias("n"), F.count_distinct("PERIOD").alias("months"))
    return per_unit.agg(
        F.max("months").alias("n_months"),
        (F.sum("gone") / F.sum("n")).alias("missing_share"),
        F.max("share").alias("worst_district_share"),
    ).select(
        "*",
        ((F.col("n_months") >= min_months) & (F.col("missing_share") <= max_missing)
         & (F.col("worst_district_share") <= max_missing_unit)).alias("usable"),
    )


def require_ready(series: DataFrame, value: str, min_months: int, max_missing: float = 0.10,
                  max_missing_unit: float = 0.20) -> None:
    """Fail with the measures of `readiness` when the series are too short or have too many gaps. Runs a job."""
    row = readiness(series, value, min_months, max_missing, max_missing_unit).first()
    if not row["usable"]:
        raise ValueError(f"series not fit for seasonality ({min_months} months needed): {row.asDict()}")


def case_seasonality(routine: DataFrame, value: str = "CONF", impute: bool = True,
                     threshold: float = 0.6) -> DataFrame:
    """Gaps of the district series are modelled first. 36 months and few gaps are required.

    The facts are read once: the district series are staged, checked and then used.
    """
    series = stage(district_months(routine, value))
    require_ready(series, value, 36)
    column = value
    if impute:
        column = f"{value}_IMPUTED"
        series = fill_gaps(series, value, column)
    return seasonality(series, column, "CASES", "CASES_PROPORTION", threshold=threshold)


def rain_seasonality(monthly: DataFrame, value: str = "MEAN", threshold: float = 0.6, max_missing: float = 0.10,
                     max_missing_unit: float = 0.20) -> DataFrame:
    """48 months and few gaps are required; `monthly` has a PERIOD."""
    series = stage(monthly.select(UNIT, YEAR, MONTH, "PERIOD", value))
    require_ready(series, value, 48, max_missing, max_missing_unit)
    return seasonality(series, value, "RAINFALL", "RAIN_PROPORTION", rainfall=True, threshold=threshold)
