"""Date predicates written so they reach the Parquet scan as PushedFilters.

A month test on a rendered date (``substr(date, 1, 6) = '201408'`` or
``LIKE '201408%'``) cannot be pushed to the scan; the equivalent half-open
range on the typed column can.  Literals are cast to the column's own type so
no cast lands on the column side.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, IntegerType, LongType, StringType, TimestampNTZType, TimestampType,
)


def _bound(df: DataFrame, col: str, day: _dt.date) -> Column:
    t = df.schema[col].dataType
    if isinstance(t, StringType):
        return F.lit(day.strftime("%Y%m%d"))
    if isinstance(t, (IntegerType, LongType)):
        return F.lit(int(day.strftime("%Y%m%d"))).cast(t)
    if isinstance(t, DateType):
        return F.lit(day)
    return F.lit(day.isoformat()).cast(t)


def month_bounds(yyyymm: str) -> tuple[_dt.date, _dt.date]:
    """``'201408'`` or ``'2014-08'`` -> (first day, first day of next month)."""
    s = yyyymm.replace("-", "")
    y, m = int(s[:4]), int(s[4:6])
    start = _dt.date(y, m, 1)
    end = _dt.date(y + (m == 12), m % 12 + 1, 1)
    return start, end


def in_half_open(df: DataFrame, col: str, start: _dt.date, end: _dt.date) -> Column:
    """``start <= col < end`` (dates, timestamps, yyyyMMdd ints or strings)."""
    return (F.col(col) >= _bound(df, col, start)) & (F.col(col) < _bound(df, col, end))


def in_closed(df: DataFrame, col: str, first: _dt.date, last: _dt.date) -> Column:
    """``first <= day(col) <= last`` as a pushable range."""
    return in_half_open(df, col, first, last + _dt.timedelta(days=1))


def month_filter(df: DataFrame, col: str, yyyymm: str) -> DataFrame:
    """Rows whose date falls in a calendar month (the ``substr(d,1,6) = m`` filter)."""
    start, end = month_bounds(yyyymm)
    return df.filter(in_half_open(df, col, start, end))


def _prefix_days(digits: str) -> list[tuple[_dt.date, _dt.date]]:
    """Closed day ranges of the dates whose yyyyMMdd form starts with ``digits``
    (years 1 to 9998; neighbouring days are merged)."""
    years = [y for y in range(1, 9999) if f"{y:04d}".startswith(digits[:4])]
    if len(digits) <= 4:
        return [(_dt.date(years[0], 1, 1), _dt.date(years[-1], 12, 31))] if years else []
    one = _dt.timedelta(days=1)
    out: list[tuple[_dt.date, _dt.date]] = []
    for y in years:                          # one year: its four digits are given
        for k in range((_dt.date(y + 1, 1, 1) - _dt.date(y, 1, 1)).days):
            d = _dt.date(y, 1, 1) + k * one
            if f"{d.year:04d}{d.month:02d}{d.day:02d}".startswith(digits):
                if out and out[-1][1] + one == d:
                    out[-1] = (out[-1][0], d)
                else:
                    out.append((d, d))
    return out


def prefix_filter(df: DataFrame, col: str, prefix: str, as_date: bool = False) -> DataFrame:
    """``col LIKE 'prefix%'`` on the column's text.

    Date and timestamp columns are matched on their yyyyMMdd form (dashes in the
    prefix are ignored), written as day ranges so that the scan can use them;
    any prefix length works.  Integer columns are matched on their digits; with
    ``as_date`` they hold yyyyMMdd and the prefix becomes ranges too.
    """
    t = df.schema[col].dataType
    dated = isinstance(t, (DateType, TimestampType, TimestampNTZType))
    digits = prefix.replace("-", "")
    if dated or (as_date and isinstance(t, (IntegerType, LongType))):
        if not digits:
            return df.filter(F.col(col).isNotNull())
        keep = F.lit(False)
        if digits.isdigit() and len(digits) <= 8:
            for first, last in _prefix_days(digits):
                keep = keep | in_closed(df, col, first, last)
        return df.filter(keep)
    return df.filter(F.col(col).cast("string").startswith(prefix))
