"""Scalar expressions with the null, NaN and ANSI rules of the panel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def clip_low(c: Column, low: float = 0.0) -> Column:
    """``max(c, low)`` that keeps null (``greatest`` alone would return ``low``)."""
    return F.when(c.isNotNull(), F.greatest(c.cast("double"), F.lit(low)))


def log_target(c: Column | str, enabled: bool = True) -> Column:
    """Label to training scale: ``log1p`` of the value clipped at zero."""
    c = as_col(c)
    return F.log1p(clip_low(c)) if enabled else c


def unlog_target(c: Column | str, enabled: bool = True) -> Column:
    """Training scale back to counts, never below zero."""
    c = as_col(c)
    return clip_low(F.expm1(c)) if enabled else c


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null instead of raising when the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def period_start(c: Column | str, grain: str = "month") -> Column:
    """First day of the period that a date or timestamp falls in."""
    day = as_col(c).cast("date")
    if grain == "day":
        return day
    if grain == "month":
        return F.trunc(day, "MM")
    raise ValueError(f"grain must be 'month' or 'day', not {grain!r}")


def period_index(c: Column | str, grain: str = "month") -> Column:
    """Periods since an arbitrary origin, so that offsets are plain integers."""
    day = as_col(c).cast("date")
    if grain == "day":
        return F.datediff(day, F.lit("1970-01-01").cast("date"))
    if grain == "month":
        return F.year(day) * 12 + F.month(day) - 1
    raise ValueError(f"grain must be 'month' or 'day', not {grain!r}")


def period_from_index(idx: Column, grain: str = "month") -> Column:
    if grain == "day":
        return F.date_add(F.lit("1970-01-01").cast("date"), idx)
    return F.make_date(F.floor(idx / 12).cast("int"), (F.pmod(idx, F.lit(12)) + 1).cast("int"), F.lit(1))


def shift_period(c: Column, steps: Column, grain: str = "month") -> Column:
    return F.add_months(c, steps) if grain == "month" else F.date_add(c, steps)


def month_flag(c: Column | str, months: Iterable[int]) -> Column:
    """1 when the month is in the set, else 0; a null date counts as 0."""
    return F.coalesce(F.month(as_col(c)).isin(*months).cast("int"), F.lit(0))


# The months behind the two season flags.
SEASONS = {
    "is_nov_jan": (11, 12, 1),
    "is_holiday_season": (10, 11, 12, 1),
}


def calendar(date: Column | str) -> dict[str, Column]:
    date = as_col(date)
    flags = {name: month_flag(date, months) for name, months in SEASONS.items()}
    return {"month": F.month(date), "quarter": F.quarter(date), **flags}


def category_id(c: Column | str, prefix: str = "id_") -> Column:
    """Numeric code to category label; a code never prints as ``101.0``."""
    c = as_col(c)
    return F.concat(F.lit(prefix), F.coalesce(c.cast("bigint").cast("string"), F.lit("nan")))
