"""Sums, ratios and casts with an explicit rule for missing values.

Three different sums are in use in this domain and mixing them up changes results:

* `sum_zero`   missing values are ignored and an all-missing group is 0,
* `sum_poison` one missing value makes the whole group null,
* `sum_any`    missing values are ignored and only an all-missing group is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_zero(c: Column | str) -> Column:
    return F.coalesce(F.sum(as_col(c)).cast("double"), F.lit(0.0))


def sum_poison(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def sum_any(c: Column | str) -> Column:
    return F.sum(as_col(c))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, null when den is 0 or either side is missing."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def positive_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, null unless den is strictly positive."""
    num, den = as_col(num), as_col(den)
    return F.when(den > 0, num.cast("double") / den)


def to_num(c: Column | str) -> Column:
    """Text to double; text that is not a number becomes null."""
    return as_col(c).cast("string").try_cast("double")


def to_num_blank(c: Column | str) -> Column:
    """As `to_num`; empty text and a lone dash count as missing."""
    text = F.trim(as_col(c).cast("string"))
    return F.nullif(F.nullif(text, F.lit("")), F.lit("-")).try_cast("double")


def truncate_int(c: Column | str) -> Column:
    """Text or number to integer, decimals cut off."""
    return to_num(c).cast("bigint")


def ceil_d(c: Column | str) -> Column:
    return F.ceil(as_col(c)).cast("double")


def round_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(as_col(c), digits)


def row_sum(cols: list[str]) -> Column:
    """Row-wise sum where a missing cell counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])


def any_true(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conds])


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def share(cond: Column) -> Column:
    """Percent of rows where `cond` holds; rows where it is null are left out."""
    return F.avg(cond.cast("double")) * 100
