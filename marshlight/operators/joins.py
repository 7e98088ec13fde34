"""Joins. No broadcast is forced: Spark broadcasts a side only below `autoBroadcastJoinThreshold`,
by file statistics or, under adaptive execution, by its measured size. Beyond that a sort-merge join runs
and adaptive execution splits skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import month_end, month_start, months_between, period_of
from .keys import first_per_key


def attach(df: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Left join of attributes, one row per key on the right."""
    cols = [c for c in right.columns if c not in keys] if cols is None else list(cols)
    return df.join(right.select(*keys, *cols).distinct(), list(keys), "left")


def attach_flag(df: DataFrame, flags: DataFrame, keys: Sequence[str], flag: str, absent: bool) -> DataFrame:
    """Bring a flag computed on a subset back to the whole table; rows not in the subset get `absent`."""
    return df.join(flags.select(*keys, flag), list(keys), "left").withColumn(
        flag, F.coalesce(flag, F.lit(absent))
    )


def update_columns(df: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   keep_old: bool = True, rounding: int | None = None) -> DataFrame:
    """Replace `cols` by the values of `new`.

    With `keep_old`, a missing new value keeps the old one; without it, missing replaces old. A key that
    `new` has twice fails the job. Numbers are rounded half to even.
    """
    rows = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(f"_new_{c}") for c in cols])
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    once = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("key occurs more than once: "), shown)).cast("boolean")).otherwise(F.lit(True))
    fresh = rows.filter(once).drop("_n")
    joined = df.join(fresh, list(keys), "left")
    out = {}
    for c in cols:
        value = F.col(f"_new_{c}")
        if rounding is not None:
            value = F.bround(value.cast("string").try_cast("double"), rounding)
        out[c] = F.coalesce(value, F.col(c)) if keep_old and c in df.columns else value
    return joined.withColumns(out).drop(*[f"_new_{c}" for c in cols]).select(
        *df.columns, *[c for c in cols if c not in df.columns]
    )


def join_summaries(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two tables with one row per key: keys known to both."""
    return left.join(right, list(keys))


def _open_span(facilities: DataFrame, months: DataFrame, opening: str, closing: str) -> tuple[DataFrame, Column, Column, Column]:
    """Facilities, first and last day within the span of `months` on which each is open, and whether there is any."""
    span = months.agg(F.min("PERIOD").alias("lo"), F.max("PERIOD").alias("hi"))
    df = facilities.withColumns({"_lo": span.select("lo").scalar(), "_hi": span.select("hi").scalar()})
    start = F.greatest(F.to_date(opening), month_start("_lo"))
    stop = F.least(F.coalesce(F.to_date(closing), month_end("_hi")), month_end("_hi"))
    return df, start, stop, F.col(opening).isNotNull() & (start <= stop)


def open_per_month(facilities: DataFrame, months: DataFrame, grid: DataFrame, keys: Sequence[str],
                   name: str = "n_open", opening: str = "OPENING_DATE", closing: str = "CLOSED_DATE") -> DataFrame:
    """`grid` (keys x PERIOD, no month missing) with the number of facilities open at some time of the month.

    Each facility gives two events, its first month and the one after its last; these are summed before the
    shuffle and run up over a key's months. No facility is repeated per month.
    """
    df, start, stop, ok = _open_span(facilities, months, opening, closing)
    events = df.filter(ok).select(*keys, F.explode(F.array(
        F.struct(period_of(start).alias("PERIOD"), F.lit(1).alias("d")),
        F.struct(period_of(F.add_months(F.trunc(stop, "month"), 1)).alias("PERIOD"), F.lit(-1).alias("d")),
    )).alias("e")).groupBy(*keys, F.col("e.PERIOD").alias("PERIOD")).agg(F.sum("e.d").alias("_d"))
    run = Window.partitionBy(*keys).orderBy("PERIOD").rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(events, [*keys, "PERIOD"], "left")
    return joined.withColumn(name, F.sum(F.coalesce("_d", F.lit(0))).over(run)).drop("_d")


def open_in_month(facilities: DataFrame, months: DataFrame, opening: str = "OPENING_DATE",
                  closing: str = "CLOSED_DATE") -> DataFrame:
    """Facility x month rows in which the facility is open at some time of the month.

    Instead of an interval join, each facility explodes the months of its own open span that fall into
    the span of `months`: no comparison of all facilities with all months.
    """
    df, start, stop, ok = _open_span(facilities, months, opening, closing)
    spans = F.when(ok, months_between(period_of(start), period_of(stop)))
    return df.withColumn("PERIOD", F.explode(spans)).drop("_lo", "_hi")


def open_at_month_start(opening: Column | str, closing: Column | str, period: Column | str) -> Column:
    """Opened on or before the first of the month and not closed by then; no opening date means not open."""
    opening = F.to_date(opening)
    closing = F.to_date(closing)
    day = month_start(period)
    return F.coalesce((opening <= day) & (closing.isNull() | (closing > day)), F.lit(False))


def open_years(facilities: DataFrame, years: DataFrame, opening: str = "OPENING_DATE",
               closing: str = "CLOSED_DATE") -> DataFrame:
    """Number of facilities open at some time of each year of `years(YEAR)`.

    Counted by summing openings and subtracting closings: each facility gives two events, events are
    summed per year before any shuffle of size, and a running total over years is taken. No facility is
    repeated per year.
    """
    span = years.agg(F.min("YEAR").alias("lo"), F.max("YEAR").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    opened = facilities.filter(F.col(opening).isNotNull())
    first = F.greatest(F.year(opening), lo)
    last = F.coalesce(F.year(closing), hi)
    events = opened.withColumns({"_first": first, "_last": last}).filter(
        (F.col("_last") >= lo) & (F.col("_first") <= hi) & (F.col("_first") <= F.col("_last"))
    )
    events = events.select(F.explode(F.array(
        F.struct(F.col("_first").alias("YEAR"), F.lit(1).alias("d")),
        F.struct((F.col("_last") + 1).alias("YEAR"), F.lit(-1).alias("d")),
    )).alias("e")).groupBy(F.col("e.YEAR").alias("YEAR")).agg(F.sum("e.d").alias("d"))
    both = years.select("YEAR", F.lit(0).alias("d"), F.lit(True).alias("keep")).unionByName(
        events.withColumn("keep", F.lit(False))
    ).groupBy("YEAR").agg(F.sum("d").alias("d"), F.max("keep").alias("keep"))
    # One row per calendar year is left here.
    run = Window.partitionBy(F.lit(1)).orderBy("YEAR").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("n_open", F.sum("d").over(run)).filter("keep").select("YEAR", "n_open")


def mapping_join(facts: DataFrame, mapping: DataFrame, dx: str = "DX", co: str = "CO",
                 how: str = "inner") -> DataFrame:
    """Facts matched to indicator definitions: on the element alone, or on element and category.

    A definition by category is dropped beforehand where the same indicator takes the whole element, so a
    fact meets an indicator once. That is settled on the mapping; the facts are read once and meet it in
    one join on the element (a broadcast, since a mapping is configuration-sized).
    """
    named = mapping.filter("DX is not null").distinct()
    whole = named.filter("CO is null").select("DX", "INDICATOR")
    parts = named.filter("CO is not null").join(whole, ["DX", "INDICATOR"], "left_anti")
    rules = whole.withColumn("CO", F.lit(None).cast("string")).unionByName(parts).select(
        F.col("DX").alias("_dx"), F.col("CO").alias("_co"), "INDICATOR")
    same = (F.col(dx) == F.col("_dx")) & (F.col("_co").isNull() | (F.col("_co") == F.col(co)))
    return facts.join(rules, same, how).drop("_dx", "_co")


def remap_units(units: DataFrame, mapping: DataFrame, keys: Sequence[str], order: Sequence[str],
                patches: Mapping[str, Mapping[str, str]] | None = None, patch_key: str = "OU_ID") -> DataFrame:
    """Old to new administrative names: first mapping row per key, a unit without one raises.

    `patches` overrides columns for single units by id.
    """
    one = first_per_key(mapping, keys, order).withColumn("_hit", F.lit(True))
    joined = units.join(one, list(keys), "left")
    joined = joined.withColumn("_hit", F.when(F.col("_hit"), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("unit without mapping: "), F.col(patch_key)))))
    for unit, values in (patches or {}).items():
        joined = joined.withColumns({
            c: F.when(F.col(patch_key) == unit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()
        })
    return joined.filter("_hit").drop("_hit")
