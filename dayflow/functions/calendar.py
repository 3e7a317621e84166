"""Calendar features: date parts, cyclic encodings, weekend / holiday flags, trend.

All are plain column expressions, so they fuse into the surrounding projection.
Holiday calendars given as a DataFrame are joined with a broadcast: a calendar
has at most one row per day, a bound that does not grow with the fact data.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values kept equal to the reference for parity of its features.
# pi as written in the reference's cyclic encodings:
PI_APPROX = 3.14159
# Holiday dates of the reference (2013-2014), in the reference's order:
HOLIDAYS_2013_2014 = (
    "2013-09-19", "2013-09-20", "2013-09-21", "2013-10-01", "2013-10-02",
    "2013-10-03", "2013-10-04", "2013-10-05", "2013-10-06", "2013-10-07", "2013-12-24",
    "2013-12-31", "2014-01-01", "2014-01-23", "2014-01-24", "2014-01-25", "2014-01-26",
    "2014-01-27", "2014-01-28", "2014-01-29", "2014-01-30",
    "2014-01-31", "2014-02-01", "2014-02-02", "2014-02-03",
    "2014-02-04", "2014-02-05", "2014-02-06", "2014-02-07",
    "2014-04-05", "2014-04-06", "2014-04-07",
    "2014-05-01", "2014-05-02", "2014-05-03", "2014-05-31", "2014-06-01", "2014-06-02",
    "2014-09-06", "2014-09-07", "2014-09-08",
)
# Weekend days that are working days in the reference:
WORKDAY_OVERRIDES_2014 = ("2014-05-04", "2014-09-28")
# Spark dayofweek numbering: 1 = Sunday ... 7 = Saturday.  The reference flags
# 6 and 7 (Friday, Saturday); the calendar weekend is 1 and 7.
WEEKEND_SUN_SAT = (1, 7)
WEEKEND_REFERENCE = (6, 7)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lits(days: Iterable[str | _dt.date]) -> list[Column]:
    return [F.lit(str(d)).cast("date") for d in days]


def weekend_flag(date_col: str | Column, weekend_days: Iterable[int] = WEEKEND_SUN_SAT,
                 workday_overrides: Iterable[str | _dt.date] = ()) -> Column:
    """1 on weekend days unless the date is a listed working day, else 0."""
    d = _c(date_col)
    flag = F.when(F.dayofweek(d).isin(list(weekend_days)), F.lit(1)).otherwise(F.lit(0))
    overrides = _date_lits(workday_overrides)
    if overrides:
        flag = F.when(d.isin(overrides), F.lit(0)).otherwise(flag)
    return flag


def holiday_flag(date_col: str | Column, holidays: Iterable[str | _dt.date] = ()) -> Column:
    """1 when the date is in a (small, literal) holiday set, else 0."""
    days = _date_lits(holidays)
    if not days:
        return F.lit(0)
    return F.when(_c(date_col).isin(days), F.lit(1)).otherwise(F.lit(0))


def join_holiday_calendar(df: DataFrame, date_col: str, calendar: DataFrame,
                          calendar_date: str = "date", out: str = "is_holiday") -> DataFrame:
    """Flag holidays from a calendar table (one row per day; broadcast is bounded by days)."""
    cal = (calendar.select(F.col(calendar_date).cast("date").alias("__hday"))
           .dropDuplicates(["__hday"]))
    return (df.join(F.broadcast(cal), F.col(date_col) == F.col("__hday"), "left")
              .withColumn(out, F.when(F.col("__hday").isNotNull(), 1).otherwise(0))
              .drop("__hday"))


def calendar_columns(date_col: str | Column, pi: float = PI_APPROX,
                     weekend_days: Iterable[int] = WEEKEND_SUN_SAT,
                     workday_overrides: Iterable[str | _dt.date] = (),
                     holidays: Iterable[str | _dt.date] = ()) -> dict[str, Column]:
    """Name -> expression for the calendar feature block.

    ``weekday`` follows Spark's ``dayofweek`` (1 = Sunday).  Cyclic terms are
    ``sin/cos(2*pi*weekday/7)`` and ``sin/cos(2*pi*month/12)``.
    """
    d = _c(date_col)
    two_pi = 2 * pi
    weekday = F.dayofweek(d)
    month = F.month(d)
    return {
        "year": F.year(d),
        "month": month,
        "day": F.dayofmonth(d),
        "weekday": weekday,
        "weekday_sin": F.sin(F.lit(two_pi) * weekday / 7),
        "weekday_cos": F.cos(F.lit(two_pi) * weekday / 7),
        "month_sin": F.sin(F.lit(two_pi) * month / 12),
        "month_cos": F.cos(F.lit(two_pi) * month / 12),
        "is_weekend": weekend_flag(d, weekend_days, workday_overrides),
        "is_holiday": holiday_flag(d, holidays),
    }


def trend_columns(date_col: str | Column, session_timestamp: bool = False,
                  zone: str | None = None) -> dict[str, Column]:
    """Trend encodings of a date.

    ``trend_days``: days since 1970-01-01 (zone-free, the default feature);
    ``trend_seconds``: seconds at UTC midnight (the timestamp form, without
    the session-time-zone dependence); ``trend_yyyymmdd``: the integer form,
    which jumps at month ends (kept for compatibility).  ``session_timestamp``
    adds ``trend_unix_timestamp`` = ``unix_timestamp`` of local midnight in
    the session time zone (the reference's form; equal to ``trend_seconds``
    only when the session zone is UTC); ``zone`` adds it for a named zone.
    """
    d = _c(date_col)
    days = F.unix_date(d)
    out = {
        "trend_days": days,
        "trend_seconds": days.cast("bigint") * F.lit(86400),
        "trend_yyyymmdd": F.date_format(d, "yyyyMMdd").cast("bigint"),
    }
    if zone is not None:
        utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), d.cast("timestamp_ntz"))
        out["trend_unix_timestamp"] = (
            F.unix_date(utc.cast("date")).cast("bigint") * 86400
            + F.hour(utc) * 3600 + F.minute(utc) * 60 + F.second(utc))
    elif session_timestamp:
        out["trend_unix_timestamp"] = F.unix_timestamp(d.cast("timestamp"))
    return out
