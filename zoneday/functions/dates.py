"""Calendar column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday import fixed_values as fv

_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "doy": F.dayofyear,
    "week": F.weekofyear,  # ISO week: 2010-01-01 lies in week 53
    "quarter": F.quarter,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_calendar(df: DataFrame, day: str = "date", parts: Sequence[str] = tuple(_PARTS)) -> DataFrame:
    return df.withColumns({p: _PARTS[p](F.col(day)) for p in parts})


def is_summer(day: Column | str, months: tuple[int, int] = fv.SUMMER_MONTHS) -> Column:
    return F.month(_col(day)).between(*months)


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def ordinal_date(year: Column | str, n: Column | str) -> Column:
    """The n-th day of a year, counted from 1."""
    return F.date_add(F.make_date(_col(year), F.lit(1), F.lit(1)), _col(n).cast("int") - 1)


def stability(
    day: Column | str,
    as_of: date,
    stable_after: int = fv.STABLE_AFTER_DAYS,
    provisional_after: int = fv.PROVISIONAL_AFTER_DAYS,
) -> Column:
    """How settled a daily value is on the day ``as_of``; never the wall clock."""
    age = F.datediff(F.lit(as_of), _col(day))
    return (
        F.when(age > stable_after, "stable").when(age > provisional_after, "provisional").otherwise("early")
    )


def in_analysis_window(
    day: Column | str,
    first_year: int | None = None,
    before: date | None = None,
    skip_years: Sequence[int] = (),
) -> Column:
    """Window and year-exclusion filter.

    The bounds compare the date itself, so they reach the scan as pushed filters.
    """
    d = _col(day)
    keep = d.isNotNull()
    if first_year is not None:
        keep = keep & (d >= F.lit(date(first_year, 1, 1)))
    if before is not None:
        keep = keep & (d < F.lit(before))
    if skip_years:
        keep = keep & ~F.year(d).isin(list(skip_years))
    return keep
