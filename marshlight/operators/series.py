"""Windows over facility and district series.

Every window here is partitioned by a series key (facility, facility x indicator, district) after the rows
have been reduced to one per month, so a partition holds at most as many rows as there are months. A
facility with a third of the raw reports is reduced before the shuffle and costs the same as any other.

Functions take the names of the value columns: one (`VALUE`) on a long table, one per indicator on a wide
table. On the wide table all indicators share one shuffle and one sort, and no row is multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.nulls import ceil_d
from . import cleaning

SERIES = ("ADM1_ID", "ADM2_ID", "OU_ID", "INDICATOR")
ORDER = ("PERIOD", "YEAR", "MONTH")


def rank_and_size(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str = "rk", size: str = "n") -> DataFrame:
    """Place of a row in its series by `order`, and the series' number of rows."""
    by = Window.partitionBy(*keys)
    return df.withColumns({rank: F.row_number().over(by.orderBy(*order)), size: F.count(F.lit(1)).over(by)})


def size_and_first(df: DataFrame, keys: Sequence[str], order: str, value: str, size: str, first: str) -> DataFrame:
    """Number of rows of a series and its first value, on every row."""
    by = Window.partitionBy(*keys)
    return df.withColumns({size: F.count(F.lit(1)).over(by), first: F.first(value).over(by.orderBy(order))})


def quartiles(value: str) -> Column:
    """First and third quartile as one aggregate."""
    return F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)))


def with_medians(df: DataFrame, values: Sequence[str], by: WindowSpec) -> DataFrame:
    """_med_<v> and _mad_<v>: unrounded median and median absolute deviation (constant 1) on every row."""
    df = df.withColumns({f"_med_{v}": F.median(v).over(by) for v in values})
    return df.withColumns({f"_mad_{v}": F.median(F.abs(F.col(v) - F.col(f"_med_{v}"))).over(by) for v in values})


def series_stats(df: DataFrame, keys: Sequence[str] = SERIES, value: str = "VALUE") -> DataFrame:
    """Mean, median, sd, MAD and quartiles of each series on every row, each rounded up to whole cases.

    Limits built from rounded statistics differ from textbook ones on purpose.
    """
    by = Window.partitionBy(*keys)
    df = with_medians(df, [value], by)
    return df.withColumns({
        "MEAN": ceil_d(F.avg(value).over(by)),
        "MEDIAN": ceil_d(f"_med_{value}"),
        "SD": ceil_d(F.stddev_samp(value).over(by)),
        "MAD": ceil_d(f"_mad_{value}"),
        "Q1": ceil_d(F.percentile(value, 0.25).over(by)),
        "Q3": ceil_d(F.percentile(value, 0.75).over(by)),
    }).drop(f"_med_{value}", f"_mad_{value}")


def outside(value: Column | str, centre_low: Column, centre_high: Column, spread: Column) -> Column:
    """True beyond `spread` from the centre(s); false when anything needed is missing."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce((value < centre_low - spread) | (value > centre_high + spread), F.lit(False))


def with_flags(df: DataFrame, values: Sequence[str], method: str, k: float, by: WindowSpec,
               prefix: str = "OUT_") -> DataFrame:
    """Boolean <prefix><v> per value column: IQR, MEAN (sd) or MEDIAN (MAD) rule on rounded-up statistics."""
    if method == "IQR":
        df = df.withColumns({f"_q_{v}": quartiles(v).over(by) for v in values})
        flags = {}
        for v in values:
            q1, q3 = ceil_d(F.col(f"_q_{v}")[0]), ceil_d(F.col(f"_q_{v}")[1])
            flags[f"{prefix}{v}"] = outside(v, q1, q3, (q3 - q1) * k)
        helpers = [f"_q_{v}" for v in values]
    elif method == "MEAN":
        df = df.withColumns({f"_mean_{v}": ceil_d(F.avg(v).over(by)) for v in values}
                            | {f"_sd_{v}": ceil_d(F.stddev_samp(v).over(by)) for v in values})
        flags = {f"{prefix}{v}": outside(v, F.col(f"_mean_{v}"), F.col(f"_mean_{v}"), F.col(f"_sd_{v}") * k)
                 for v in values}
        helpers = [f"_{s}_{v}" for v in values for s in ("mean", "sd")]
    elif method == "MEDIAN":
        df = with_medians(df, values, by)
        flags = {f"{prefix}{v}": outside(v, ceil_d(f"_med_{v}"), ceil_d(f"_med_{v}"), ceil_d(f"_mad_{v}") * k)
                 for v in values}
        helpers = [f"_{s}_{v}" for v in values for s in ("med", "mad")]
    else:
        raise ValueError(f"unknown method {method}")
    return df.withColumns(flags).drop(*helpers)


def with_mad_flags(df: DataFrame, values: Sequence[str], deviation: float, by: WindowSpec, prefix: str,
                   constant: float = 1.0) -> DataFrame:
    """As the MEDIAN rule, on unrounded statistics; usually by facility and year."""
    df = with_medians(df, values, by)
    flags = {f"{prefix}{v}": outside(v, F.col(f"_med_{v}"), F.col(f"_med_{v}"),
                                     F.col(f"_mad_{v}") * (constant * deviation)) for v in values}
    return df.withColumns(flags).drop(*[f"_{s}_{v}" for v in values for s in ("med", "mad")])


def mad_flag(df: DataFrame, deviation: float, name: str, keys: Sequence[str] = ("YEAR", "OU_ID", "INDICATOR"),
             constant: float = 1.0) -> DataFrame:
    """Long-table form of `with_mad_flags`."""
    out = with_mad_flags(df, ["VALUE"], deviation, Window.partitionBy(*keys), "_flag_", constant)
    return out.withColumnRenamed("_flag_VALUE", name)


def _median_of_frame(values: Column) -> Column:
    s, n = F.array_sort(values), F.size(values)
    upper = F.get(s, (n / 2).cast("int"))
    lower = F.get(s, ((n - 1) / 2).cast("int"))
    return F.when(n > 0, (lower + upper) / 2)


def with_imputed(df: DataFrame, values: Sequence[str], how: str, keys: Sequence[str],
                 order: Sequence[str] = ORDER, flags: str = "OUT_", prefix: str = "FILL_") -> DataFrame:
    """<prefix><v>: the value, or the mean/median of the row and its two neighbours, rounded up.

    Flagged values count as missing. Every missing value is filled, not only flagged ones. The first and
    the last row of a series have no full neighbourhood and stay missing.
    """
    near = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-1, 1)
    df = df.withColumns({f"_kept_{v}": F.when(~F.col(f"{flags}{v}"), F.col(v)) for v in values})
    full = F.count(F.lit(1)).over(near) == 3
    out = {}
    for v in values:
        if how == "mean":
            middle = F.avg(f"_kept_{v}").over(near)
        elif how == "median":
            middle = _median_of_frame(F.collect_list(f"_kept_{v}").over(near))  # at most three values
        else:
            raise ValueError(how)
        out[f"{prefix}{v}"] = F.coalesce(F.col(f"_kept_{v}"), F.when(full, ceil_d(middle)))
    return df.withColumns(out).drop(*[f"_kept_{v}" for v in values])


def trimmed_stats(df: DataFrame, keys: Sequence[str], values: Sequence[str], *extra: Column) -> DataFrame:
    """MEAN_80_<v> and SD_80_<v> per series: the middle 80 % of its positive values, rounded up.

    The sorted values of a series are an array as long as its number of months. `extra` aggregates ride along.
    """
    arrays = df.groupBy(*keys).agg(*[
        F.array_sort(F.collect_list(F.when(F.col(v) > 0, F.col(v)))).alias(v) for v in values], *extra)
    arrays = arrays.withColumns({v: _middle_80(v) for v in values})
    arrays = arrays.withColumns({
        f"_m_{v}": F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)) for v in values})
    cols = []
    for v in values:
        cols += [ceil_d(f"_m_{v}").alias(f"MEAN_80_{v}"), ceil_d(_sample_sd(v, f"_m_{v}")).alias(f"SD_80_{v}")]
    kept = [c for c in arrays.columns if c not in (*keys, *values) and not c.startswith("_m_")]
    return arrays.select(*keys, *cols, *kept)


def _middle_80(values: str) -> Column:
    """Of a sorted array, the elements ranked above 10 % and up to 90 %."""
    n = F.size(values)
    return F.filter(values, lambda x, i: (i + 1 > n * F.lit(0.1)) & (i + 1 <= n * F.lit(0.9)))


def _sample_sd(values: str, mean: str) -> Column:
    n = F.size(values)
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - F.col(mean)) * (x - F.col(mean)))
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def forward_sum(value: str, months: int, unit: str, order: Sequence[str]) -> Column:
    """Sum over this and the next months; null when fewer than `months` rows remain, 0 when all are missing."""
    ahead = Window.partitionBy(unit).orderBy(*order).rowsBetween(0, months - 1)
    return F.when(
        F.count(F.lit(1)).over(ahead) == months, F.coalesce(F.sum(value).over(ahead), F.lit(0.0))
    )


def carry_forward(df: DataFrame, space: str, time: str, order: str, value: str) -> DataFrame:
    """Missing values take the last known value of the same (space, time), in `order`."""
    past = Window.partitionBy(space, time).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(past))


def cycles_long(df: DataFrame, space: str, time: str, cols: Sequence[str]) -> DataFrame:
    """Highest percentage (read from the column name) reached for each number of cycles."""
    long = df.select(space, time, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [space, time], list(cols), "category", "num_cycles"
    )
    pct = F.regexp_extract("category", r"(\d+)", 1).cast("int")
    return (
        long.filter("num_cycles is not null")
        .groupBy(space, time, "num_cycles")
        .agg(F.max(pct).alias("max_pct_covered"))
    )


def max_back_on_rows(df: DataFrame, target: str, keys: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, F.max(target).over(Window.partitionBy(*keys)))


# --- seasonal cleaning ------------------------------------------------------------------------------


def with_seasonal_flag(df: DataFrame, deviation: float | Sequence[float], name: str, keys: Sequence[str] = ("OU_ID", "INDICATOR"),
                       order: Sequence[str] = ("PERIOD",), value: str = "VALUE", out: str | None = None) -> DataFrame:
    """Flag values far from their cleaned monthly series, in units of the series' MAD (see `cleaning`).

    Several deviations are passes one after the other: each takes the rows that no pass before it flagged as the series. Rows that
    `out` marks are flagged from the start. A series with fewer than two values or with MAD 0 has no outlier. Each series becomes one
    sorted array, so all steps and passes run on one row; the columns that are not needed pass by untouched.
    """
    deviations = [deviation] if isinstance(deviation, (int, float)) else list(deviation)
    cols = df.columns
    rows = F.array_sort(F.collect_list(F.struct(*order, *[c for c in cols if c not in (*order, *keys)])))
    series = df.groupBy(*keys).agg(rows.alias("_rows"))
    before = F.transform("_rows", lambda r: r[out] if out else F.lit(False))
    flags = _seasonal_flags(deviations)(F.transform("_rows", lambda r: r[value].cast("double")), before)
    flagged = series.select(*keys, F.explode(F.arrays_zip("_rows", flags.alias("_flags"))).alias("_r"))
    others = [c for c in cols if c != name]
    return flagged.select(*[F.col(c) if c in keys else F.col(f"_r._rows.{c}").alias(c) for c in others], F.col("_r._flags").alias(name))


def _seasonal_flags(deviations: Sequence[float]):
    """Flags of arrays of values and of flags so far; series of one length are cleaned together.

    A series from which a pass took nothing is not cleaned again for the next.
    """
    @F.pandas_udf("array<boolean>")
    def flags(values: pd.Series, before: pd.Series) -> pd.Series:
        gone = [np.array(b, dtype=bool) for b in before]
        full = [np.asarray(v, dtype=float) for v in values]
        rest, far = [np.flatnonzero(~g) for g in gone], [np.zeros(0)] * len(gone)
        fresh = np.ones(len(gone), dtype=bool)
        for deviation in deviations:
            lengths = np.array([len(r) for r in rest], dtype=int) * fresh
            for n in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == n)
                for k, d in zip(at, cleaning.seasonal_distance(np.stack([full[k][rest[k]] for k in at]))):
                    far[k] = d
            fresh[:] = False
            for k, d in enumerate(far):
                found = d >= deviation
                if found.any():
                    gone[k][rest[k]] = found
                    rest[k], far[k], fresh[k] = rest[k][~found], np.zeros(0), True
        return pd.Series(gone)

    return flags
