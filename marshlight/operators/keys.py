"""Keys: duplicates, deduplication, membership, set comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in `order`, missing values last.

    Done as `min_by` instead of a row-number window: the minimum is combined before the shuffle, so a key
    that holds a large part of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = F.struct(*[part for c in cols for part in (c.isNull(), c)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def fullest(cols: Sequence[str]) -> list[Column]:
    """An order for `first_per_key`: most known values of `cols` first, then the lowest values."""
    known = sum((F.col(c).isNotNull().cast("int") for c in cols[1:]), F.col(cols[0]).isNotNull().cast("int"))
    return [-known, *[F.col(c) for c in cols]]


def only_in_left(left: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str]) -> DataFrame:
    """Distinct value combinations of `left` that `right` lacks (nulls compare equal)."""
    return left.select(*left_cols).subtract(right.select(*right_cols).toDF(*left_cols))


def sets_match(left: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str]) -> DataFrame:
    """One row: numbers of values found on one side only, and whether both are zero."""
    a = left.select(*left_cols).distinct().withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
    b = right.select(*right_cols).toDF(*left_cols).distinct().withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    sides = a.unionByName(b).groupBy(*left_cols).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return sides.agg(
        F.count_if(F.col("_r") == 0).alias("only_left"),
        F.count_if(F.col("_l") == 0).alias("only_right"),
    ).withColumn("matches", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def groups_with_missing(df: DataFrame, key: str, target: str) -> DataFrame:
    """All rows of the groups that have at least one missing `target`."""
    bad = df.filter(F.col(target).isNull()).select(key).distinct()
    return df.join(bad, key, "left_semi")


def complete_groups(df: DataFrame, upper: str, lower: str) -> DataFrame:
    """Rows of the `upper` groups in which every value of `lower` seen anywhere occurs.

    Distinct (upper, lower) pairs are counted with ordinary partial aggregation; only the one-row total
    and the list of complete groups are joined back.
    """
    pairs = df.select(upper, lower).distinct()
    per_group = pairs.groupBy(upper).agg(F.count(lower).alias("_n"))
    total = df.select(lower).distinct().agg(F.count(lower).alias("_total"))
    full = per_group.join(total, F.col("_n") == F.col("_total")).select(upper)
    return df.join(full, upper, "left_semi")


def top_summed_groups(df: DataFrame, target: str, group: str) -> DataFrame:
    """The group(s) with the largest total, all ties kept, and the number of ties."""
    totals = df.groupBy(group).agg(F.coalesce(F.sum(target), F.lit(0)).alias("top_value"))
    best = totals.groupBy("top_value").agg(F.count(F.lit(1)).alias("n_top"))
    best = best.agg(F.max_by(F.struct("top_value", "n_top"), "top_value").alias("_b")).select("_b.*")
    return totals.join(best, "top_value").select(group, "top_value", "n_top")


def first_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """The first `n` distinct values of `group` in order."""
    return df.select(group).distinct().orderBy(group).limit(n)


def in_first_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of the first `n` values of `group`."""
    return df.join(first_groups(df, group, n), group, "left_semi").select(*df.columns)


def count_distinct_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """One row: the number of different key combinations, e.g. of series."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(name))


def range_and_latest(df: DataFrame, keys: Sequence[str], period: str, value: str, missing: float) -> DataFrame:
    """First and last period of each group, and the value of its last period (`missing` where that is unknown)."""
    return df.groupBy(*keys).agg(
        F.min(period).alias("lo"), F.max(period).alias("hi"),
        F.max_by(F.coalesce(F.col(value), F.lit(missing)), period).alias("latest"))


def most_complete_first(df: DataFrame, key: str, value: str, name: str = "n") -> DataFrame:
    """All groups with their number of known values, the fullest first, ties by key."""
    return df.groupBy(key).agg(F.count(value).alias(name)).orderBy(F.desc(name), key)
