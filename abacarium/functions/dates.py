"""Date helpers that keep predicates in the form a Parquet scan can use."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_of(value: Column | str) -> Column:
    """``yyyy-MM`` of a date, for grouping. Filter with :func:`month_range` instead."""
    return F.date_format(_col(value), "yyyy-MM")


def month_start(value: Column | str) -> Column:
    """The first day of the month: a cheap key to group rows by, see :func:`month_label`."""
    return F.trunc(F.to_date(_col(value)), "month")


def month_label(value: Column | str) -> Column:
    """``yyyy-MM`` of a month start, for the few rows that are left after grouping."""
    return F.date_format(_col(value), "yyyy-MM")


def quarter_label(value: Column | str) -> Column:
    return F.concat(F.lit("Q"), _col(value).cast("string"))


def date_key(value: Column | str) -> Column:
    """The integer key ``yyyymmdd``."""
    value = _col(value)
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def in_range(column: Column | str, start: dt.date | str, end: dt.date | str, of: str = "timestamp_ntz") -> Column:
    """``start <= column < end`` on the bare column, so that the scan can skip row groups."""
    column = _col(column)
    low, high = F.lit(str(start)).cast(of), F.lit(str(end)).cast(of)
    return (column >= low) & (column < high)


def month_range(column: Column | str, month: str, months: int = 1, of: str = "timestamp_ntz") -> Column:
    """The half-open range of ``months`` months from ``month`` (``yyyy-MM``) on."""
    year, number = (int(part) for part in month.split("-"))
    last = number - 1 + months
    return in_range(column, f"{year:04d}-{number:02d}-01", f"{year + last // 12:04d}-{last % 12 + 1:02d}-01", of)


def year_range(column: Column | str, year: int, of: str = "timestamp_ntz") -> Column:
    return in_range(column, f"{year:04d}-01-01", f"{year + 1:04d}-01-01", of)


def parse_or_null(column: Column | str, pattern: str | None = None) -> Column:
    """A timestamp, NULL where the text is no valid time."""
    column = _col(column)
    return F.try_to_timestamp(column) if pattern is None else F.try_to_timestamp(column, F.lit(pattern))
