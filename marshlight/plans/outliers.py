"""Outlier detection and imputation of monthly facility data.

All jobs work on the wide table: one row per facility and month, one column per indicator. After the
deduplication a single repartition by facility serves every later window and aggregation, whatever the
number of indicators or passes; the long `detected` table is unfolded row by row at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import ratio
from ..functions.periods import month_of, year_of
from ..operators import series as S
from ..operators.keys import first_per_key, fullest
from ..operators.shape import long_form, long_many

FIXED = ("PERIOD", "YEAR", "MONTH", "ADM1_ID", "ADM2_ID", "OU_ID")
NAMES = ("ADM1_NAME", "ADM2_NAME", "OU_NAME")
PLACE = ("ADM1_ID", "ADM2_ID", "OU_ID")

# Default distance and imputation of each method.
METHODS = {"IQR": (1.5, "mean"), "MEAN": (3, "mean"), "MEDIAN": (3, "median")}


class Outcome(NamedTuple):
    """Detected (long, one row per value), imputed and removed (wide)."""

    detected: DataFrame
    imputed: DataFrame
    removed: DataFrame


def routine_long(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    return long_form(routine, FIXED, indicators)


def facility_months(routine: DataFrame, indicators: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per facility and month, partitioned by facility.

    Of several rows the first in `order` is kept, by default the one with the most known indicators. The choice is an aggregation, so
    repeated rows are gone before the facility shuffle and no facility is larger than the calendar.
    """
    names = [c for c in NAMES if c in routine.columns]
    table = routine.select(*FIXED, *names, *[F.col(i).cast("double").alias(i) for i in indicators])
    return by_facility(first_per_key(table, FIXED, list(order) if order else fullest(indicators)))


def by_facility(df: DataFrame) -> DataFrame:
    """Partitioned by facility in as many parts as the session shuffles into.

    The number is explicit because the work that follows (many windows, rows unfolded per indicator) is far
    larger than the shuffled bytes by which adaptive execution would merge partitions.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "OU_ID")


def _flags(df: DataFrame, indicators: Sequence[str], flag: str, value: str = "") -> DataFrame:
    """Long rows (FIXED, names, INDICATOR, VALUE, FLAG) from the wide table; the partitioning is kept."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("INDICATOR"), F.col(f"{value}{i}").alias("VALUE"), F.col(f"{flag}{i}").alias("FLAG"))
        for i in indicators])
    keep = [*FIXED, *[c for c in NAMES if c in df.columns]]
    return df.select(*keep, F.explode(rows).alias("_r")).select(*keep, "_r.*")


def detected_table(df: DataFrame, indicators: Sequence[str], method: str, flag: str = "OUT_") -> DataFrame:
    return _flags(df, indicators, flag).withColumnRenamed("FLAG", "OUTLIER_DETECTED").withColumns({
        "OUTLIER_METHOD": F.lit(method), "DATE": F.make_date("YEAR", "MONTH", F.lit(1))})


def wide_table(df: DataFrame, cells: dict[str, Column]) -> DataFrame:
    names = [c for c in NAMES if c in df.columns]
    order = ["PERIOD", "YEAR", "MONTH", "ADM1_NAME", "ADM1_ID", "ADM2_NAME", "ADM2_ID", "OU_ID", "OU_NAME"]
    return df.select(*[c for c in order if c in FIXED or c in names], *[c.alias(i) for i, c in cells.items()])


def flag_series(long: DataFrame, method: str, k: float | None = None) -> DataFrame:
    """Long-table form of the three rules: OUTLIER_DETECTED per row."""
    out = S.with_flags(long, ["VALUE"], method, METHODS[method][0] if k is None else k, Window.partitionBy(*S.SERIES))
    return out.withColumnRenamed("OUT_VALUE", "OUTLIER_DETECTED")


def detect(long: DataFrame, method: str, k: float | None = None) -> DataFrame:
    """Long-table form with VALUE_IMPUTED.

    Dealt by facility, and sorted once for the statistics and for the neighbours, so a task holds one sorted copy of its rows.
    """
    dealt = by_facility(long).sortWithinPartitions(*S.SERIES, *S.ORDER)
    flagged = flag_series(dealt, method, k).withColumn("OUT_VALUE", F.col("OUTLIER_DETECTED"))
    out = S.with_imputed(flagged, ["VALUE"], METHODS[method][1], S.SERIES)
    return out.withColumnRenamed("FILL_VALUE", "VALUE_IMPUTED").drop("OUT_VALUE")


def run(routine: DataFrame, indicators: Sequence[str], method: str, k: float | None = None) -> Outcome:
    """IQR, mean and median methods.

    The removed table drops flagged cells, and rows whose cells are all flagged, and carries the imputed
    value in the cells that stay.
    """
    distance, how = METHODS[method]
    df = facility_months(routine, indicators)
    df = S.with_flags(df, indicators, method, distance if k is None else k, Window.partitionBy(*PLACE))
    filled = S.with_imputed(df, indicators, how, PLACE)
    kept = filled.filter(~_all([F.col(f"OUT_{i}") for i in indicators]))
    return Outcome(
        detected_table(df, indicators, method),
        wide_table(filled, {i: F.col(f"FILL_{i}") for i in indicators}),
        wide_table(kept, {i: F.when(~F.col(f"OUT_{i}"), F.col(f"FILL_{i}")) for i in indicators}),
    )


def _all(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


# --- staged detection -------------------------------------------------------------------------------


def staged_mad(df: DataFrame, indicators: Sequence[str], first: float = 15, second: float = 10) -> DataFrame:
    """Yearly MAD at a wide limit, then at a narrower one on what is left: FIRST_<i> and OUT_<i>.

    A value removed by the first pass is an outlier of both. The second pass reads the column with those
    values nulled instead of joining a filtered copy back; statistics skip nulls, so the result is the same.
    """
    year = Window.partitionBy("OU_ID", "YEAR")
    df = S.with_mad_flags(df, indicators, first, year, "FIRST_")
    rest = {f"_rest_{i}": F.when(~F.col(f"FIRST_{i}"), F.col(i)) for i in indicators}
    df = S.with_mad_flags(df.withColumns(rest), list(rest), second, year, "_then_")
    df = df.withColumns({f"OUT_{i}": F.col(f"FIRST_{i}") | F.col(f"_then__rest_{i}") for i in indicators})
    return df.drop(*rest, *[f"_then_{r}" for r in rest])


def staged_seasonal(long: DataFrame, flag: str = "FLAG", first: float = 5, second: float = 3) -> DataFrame:
    """Seasonal passes over a long table with the flag of what is out already; each pass looks at what is left.

    Both passes run on one array for each series. What Spark knows of the partitioning is lost in Python, so the rows are dealt by
    facility once more, for all that follows.
    """
    return by_facility(S.with_seasonal_flag(long, (first, second), flag, out=flag))


def run_staged(routine: DataFrame, indicators: Sequence[str], complete: bool = False) -> Outcome:
    """MAD 15 then MAD 10; `complete` adds the seasonal passes. Removed values become null, rows stay."""
    df = staged_mad(facility_months(routine, indicators), indicators)
    method = "MAGIC_GLASSES_PARTIAL"
    if complete:
        method = "MAGIC_GLASSES_COMPLETE"
        long = staged_seasonal(_flags(df, indicators, "OUT_"))
        names = [c for c in NAMES if c in df.columns]
        # one row per facility-month again; the facility partitioning still holds
        df = long.groupBy(*FIXED, *names).agg(*[
            F.max(F.when(F.col("INDICATOR") == i, F.col(c))).alias(f"{p}{i}")
            for i in indicators for c, p in (("VALUE", ""), ("FLAG", "OUT_"))])
    filled = S.with_imputed(df, indicators, "mean", PLACE)
    return Outcome(
        detected_table(df, indicators, method),
        wide_table(filled, {i: F.col(f"FILL_{i}") for i in indicators}),
        wide_table(df, {i: F.when(~F.col(f"OUT_{i}"), F.col(i)) for i in indicators}),
    )


# --- clinical pathway rules -------------------------------------------------------------------------

# Values below these are never flagged.
FLOORS = {"TEST": 50, "PRES": 50, "CONF": 10}


def full_grid(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Every facility x month seen, wide, with MEAN_80_<i> and SD_80_<i> of the facility.

    A facility's months are gathered in one row (as long as the calendar), its trimmed statistics are taken
    there, and the row is unfolded into its months and the ones it lacks: no join and no shuffle of the grid.
    """
    names = [c for c in NAMES if c in routine.columns]
    table = routine.select(*PLACE, "PERIOD", *names, *[F.col(i).cast("double").alias(i) for i in indicators])
    one = first_per_key(table, [*PLACE, "PERIOD"], fullest(indicators))
    month = F.struct("PERIOD", *indicators)
    places = S.trimmed_stats(one, [*PLACE, *names], indicators, F.collect_list(month).alias("_rows"))
    calendar = routine.agg(F.array_sort(F.collect_set("PERIOD")).alias("m")).scalar()  # the calendar's length
    period = dict(routine.dtypes)["PERIOD"]
    places = places.withColumn("_lack", F.array_except(calendar, F.transform("_rows", lambda r: r["PERIOD"])))
    missing = F.transform("_lack", lambda p: F.struct(
        p.cast(period).alias("PERIOD"), *[F.lit(None).cast("double").alias(i) for i in indicators]))
    grid = places.withColumn("_r", F.explode(F.concat("_rows", missing))).drop("_rows", "_lack")
    stats = [c for c in places.columns if c.startswith(("MEAN_80_", "SD_80_"))]
    return grid.select(*PLACE, *names, "_r.*", *stats).withColumns({"YEAR": year_of("PERIOD"), "MONTH": month_of("PERIOD")})


def full_grid_long(routine: DataFrame, indicators: Sequence[str]) -> DataFrame:
    return long_form(full_grid(routine, indicators), [*PLACE, "PERIOD"], indicators)


def pathway_flags(grid: DataFrame, indicators: Sequence[str], deviation: float = 10) -> DataFrame:
    """TREND_<i>: unusually high against the trimmed mean, and not below the floor."""
    flags = {}
    for i in indicators:
        high = F.col(i) > F.col(f"MEAN_80_{i}") + F.col(f"SD_80_{i}") * deviation
        if i in FLOORS:
            high = high & (F.col(i) >= FLOORS[i])
        flags[f"TREND_{i}"] = F.coalesce(high, F.lit(False))
    return grid.withColumns(flags)


def pathway_exceptions(flagged: DataFrame, indicators: Sequence[str], deviation: float = 10) -> DataFrame:
    """POSSIBLE_STKOUT, POSSIBLE_EPID and the corrected flags OUT_<i>.

    Without PRES there is no stock-out rule. A possible stock-out (few tests, presumed cases high but within the usual range of tests) clears the
    flag of PRES. A possible epidemic is recorded and changes no flag. The rules compare indicators of one
    facility and month, which is one row here.
    """
    c = F.col
    usual = c("MEAN_80_TEST") + c("SD_80_TEST") * deviation
    stockout = F.lit(False)
    if "PRES" in indicators:
        stockout = c("TREND_PRES") & (c("TEST") < c("MEAN_80_TEST")) & (c("PRES") < usual)
    epidemic = c("TREND_CONF") & (c("TREND_TEST") | (c("TEST") >= c("CONF")))
    df = flagged.withColumns({"POSSIBLE_STKOUT": F.when(stockout, True), "POSSIBLE_EPID": F.when(epidemic, True)})
    return df.withColumns({
        f"OUT_{i}": c("TREND_PRES") & c("POSSIBLE_STKOUT").isNull() if i == "PRES" else c(f"TREND_{i}")
        for i in indicators})


def pathway_impute(clean: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """FILL_<i> and final OUT_<i>; TEST and CONF go back when imputing made TEST < CONF."""
    df = clean.withColumns({
        f"FILL_{i}": F.when(F.col(f"OUT_{i}"), F.col(f"MEAN_80_{i}")).otherwise(F.col(i)) for i in indicators})
    undo = F.coalesce((F.col("FILL_TEST") < F.col("FILL_CONF")) & (F.col("TEST") > F.col("CONF")), F.lit(False))
    df = df.withColumn("_undo", undo)
    back = {}
    for i in ("TEST", "CONF"):
        back[f"FILL_{i}"] = F.when(F.col("_undo"), F.col(i)).otherwise(F.col(f"FILL_{i}"))
        back[f"OUT_{i}"] = F.col(f"OUT_{i}") & ~F.col("_undo")
    return df.withColumns(back).drop("_undo")


def run_pathway(routine: DataFrame, indicators: Sequence[str], deviation: float = 10) -> Outcome:
    clean = pathway_exceptions(pathway_flags(full_grid(routine, indicators), indicators, deviation), indicators,
                               deviation)
    done = pathway_impute(clean, indicators)
    removed = wide_table(done, {i: F.when(~F.col(f"OUT_{i}"), F.col(f"FILL_{i}")) for i in indicators})
    return Outcome(
        detected_table(clean, indicators, "PATH"),
        wide_table(done, {i: F.col(f"FILL_{i}") for i in indicators}),
        removed.dropna(how="all", subset=list(indicators)),
    )


def imputed_long(done: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Old value, imputed value and flag side by side, one row per indicator."""
    df = done.withColumnsRenamed({i: f"VALUE_OLD_{i}" for i in indicators} | {f"FILL_{i}": f"VALUE_IMPUTED_{i}" for i in indicators}
                                 | {f"OUT_{i}": f"OUTLIER_TREND_{i}" for i in indicators})
    return long_many(df, FIXED, "INDICATOR", indicators, ["VALUE_OLD", "VALUE_IMPUTED", "OUTLIER_TREND"])


# --- reporting on results ---------------------------------------------------------------------------


def outlier_counts(detected: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    flag = F.col("OUTLIER_DETECTED")
    return detected.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(flag).alias("n_outliers"),
        F.count_distinct(F.when(flag, F.col("OU_ID"))).alias("n_facilities"),
    ).withColumn("pct_outliers", ratio("n_outliers", "n_values") * 100)


def outliers_by_date(detected: DataFrame) -> DataFrame:
    return detected.groupBy("INDICATOR", "YEAR", "MONTH").agg(
        F.sum("VALUE").alias("total"), F.bool_or("OUTLIER_DETECTED").alias("has_outlier"))
