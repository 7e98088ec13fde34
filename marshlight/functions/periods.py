"""Monthly and weekly period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


def year_of(period: Column | str) -> Column:
    return F.substring(as_col(period).cast("string"), 1, 4).cast("int")


def month_of(period: Column | str) -> Column:
    return F.substring(as_col(period).cast("string"), 5, 2).cast("int")


def period_of(ts: Column | str) -> Column:
    """yyyymm as an integer."""
    ts = as_col(ts)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def month_start(period: Column | str) -> Column:
    p = as_col(period).cast("int")
    return F.make_date((p / 100).cast("int"), p % 100, F.lit(1))


def month_end(period: Column | str) -> Column:
    return F.last_day(month_start(period))


def month_index(period: Column | str) -> Column:
    """Months since year 0: consecutive months differ by one."""
    p = as_col(period).cast("int")
    return (p / 100).cast("int") * 12 + p % 100 - 1


def months_between(first: Column, last: Column) -> Column:
    """Array of yyyymm integers from `first` to `last`, both included."""
    days = F.sequence(month_start(first), month_start(last), F.expr("interval 1 month"))
    return F.transform(days, period_of)


def year_month_label(year: Column | str, month: Column | str) -> Column:
    return F.format_string("%d-%02d", as_col(year).cast("int"), as_col(month).cast("int"))


def week_key(day: Column | str, first_weekday: int = 0, mark: str = "W") -> Column:
    """Week key such as 2020W53 for weeks starting on `first_weekday` (0 = Monday).

    A week belongs to the year of its fourth day; with Monday weeks this is the ISO rule.
    """
    day = as_col(day).cast("date")
    since_start = F.pmod(F.weekday(day) - F.lit(first_weekday), F.lit(7))
    middle = F.date_add(F.date_sub(day, since_start), 3)
    number = ((F.dayofyear(middle) - 1) / 7).cast("int") + 1
    return F.concat(F.year(middle).cast("string"), F.lit(mark), F.lpad(number.cast("string"), 2, "0"))


def iso_week(day: Column | str) -> Column:
    return week_key(day)


def epi_week(day: Column | str) -> Column:
    """Epidemiological week: weeks that start on Thursday."""
    return week_key(day, first_weekday=3, mark="ThuW")


def month_key(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyyyMM")
