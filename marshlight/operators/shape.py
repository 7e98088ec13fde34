"""Wide and long forms, typed padding, grids and unions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import months_between


def require(df: DataFrame, cols: Sequence[str], what: str = "input") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s): {', '.join(missing)}")
    return df


def long_form(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "INDICATOR",
              value: str = "VALUE") -> DataFrame:
    require(df, [*ids, *values])
    typed = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return typed.unpivot(list(ids), list(values), name, value)


def wide_form(df: DataFrame, keys: Sequence[str], names: Sequence[str], name: str = "INDICATOR",
              value: str = "VALUE", agg: str = "first") -> DataFrame:
    """One column per listed name. The list is explicit, so no extra job looks for it."""
    how = {"first": lambda c: F.first(c, ignorenulls=True), "sum": F.sum, "max": F.max}[agg]
    cells = [how(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names]
    return df.groupBy(*keys).agg(*cells)


def wide_many(df: DataFrame, keys: Sequence[str], name: str, names: Sequence[str],
              values: Sequence[str]) -> DataFrame:
    """Several value columns at once, named value_name."""
    cells = [
        F.first(F.when(F.col(name) == n, F.col(v)), ignorenulls=True).alias(f"{v}_{n}")
        for v in values
        for n in names
    ]
    return df.groupBy(*keys).agg(*cells)


def long_many(df: DataFrame, keys: Sequence[str], name: str, names: Sequence[str],
              values: Sequence[str]) -> DataFrame:
    """Back from `wide_many`: columns value_name become rows of (name, values...)."""
    rows = F.array(*[
        F.struct(F.lit(n).alias(name), *[F.col(f"{v}_{n}").alias(v) for v in values]) for n in names
    ])
    return df.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def pad_columns(df: DataFrame, order: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """Columns in a fixed order; those that are missing become typed nulls."""
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c) for c in order
    ])


def empty_template(df: DataFrame, keys: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct().select(*keys, *[F.lit(None).cast("double").alias(c) for c in numeric])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def cast_like(df: DataFrame, reference: DataFrame) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in reference.schema.fields}
    return cast_columns(df, types)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_all_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(cols))


def month_list(df: DataFrame, period: str = "PERIOD") -> Column:
    """Array of all months between the first and the last seen, as a scalar subquery."""
    span = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    return span.select(months_between(F.col("lo"), F.col("hi")).alias("months")).scalar()


def with_every_month(units: DataFrame, facts: DataFrame, period: str = "PERIOD") -> DataFrame:
    """Each row of `units` for each month of `facts`.

    The months are one small array; each unit row explodes it in place, so the grid (which is units x
    months by definition) is made without a join or a shuffle.
    """
    grid = units.withColumn("_months", month_list(facts, period))
    return grid.withColumn(period, F.explode("_months")).drop("_months")


def with_values(units: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Each row of `units` for each value of a short driver-side list."""
    return units.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def complete_months(df: DataFrame, unit_cols: Sequence[str], facts_cols: Sequence[str],
                    period: str = "PERIOD") -> DataFrame:
    """Data on the full unit x month grid; cells without data are null."""
    grid = with_every_month(df.select(*unit_cols).distinct(), df, period)
    return grid.join(df.select(*unit_cols, period, *facts_cols), [*unit_cols, period], "full")


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def constant_columns(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))
