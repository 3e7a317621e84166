"""Feature queries: calendar block, weekend / holiday flags, trend encodings and
exact-date lag features."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayflow.functions import calendar as cal
from dayflow.functions.clean import to_day
from dayflow.operators import lags
from dayflow.plans.inputs import event_panel_days, table
from dayflow.plans.panel_queries import EVENT_DAYS_SQL
from dayflow.plans.registry import register

# Fixed-date holidays that recur every year in the reference's holiday list
# (New Year 01-01, Labour Day 05-01..05-03, National Day 10-01..10-07), as
# month-day pairs; the annual calendar repeats them for every year in the data.
ANNUAL_HOLIDAYS = ("01-01", "05-01", "05-02", "05-03", "10-01", "10-02", "10-03",
                   "10-04", "10-05", "10-06", "10-07")
TREND_ZONE = "Asia/Shanghai"       # a fixed zone, so the result needs no session setting
LAG_MEASURES = ("value_sum", "n_events")
# Holidays and working-day overrides that occur in the driver data (1995-2001),
# beside the reference's 2013-2014 dates: both branches of every flag are seen.
DATA_HOLIDAYS = ("1996-01-01", "1997-10-01", "1998-05-01", "1999-10-02", "2000-05-03")
DATA_WORKDAYS = ("1998-05-02", "1999-10-01", "2000-09-30")      # Saturday, Friday, Saturday
HOLIDAYS = cal.HOLIDAYS_2013_2014 + DATA_HOLIDAYS
WORKDAYS = cal.WORKDAY_OVERRIDES_2014 + DATA_WORKDAYS


def _order_days(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(to_day("o_orderdate").alias("report_date")).distinct()


def annual_holiday_calendar(days, date_col: str = "report_date",
                            month_days=ANNUAL_HOLIDAYS):
    """(date) rows: each listed month-day in every year spanned by ``days``.

    One row per holiday per year: bounded by the calendar, not by the data.
    """
    years = days.select(F.year(date_col).alias("y")).distinct()
    md = F.array(*[F.lit(x) for x in month_days])
    # try_to_date: a month-day absent from some year (02-29) is skipped, not an error
    day = F.try_to_date(F.concat_ws("-", F.col("y").cast("string"), F.col("md")), "yyyy-MM-dd")
    return (years.select(F.explode(md).alias("md"), "y").select(day.alias("date"))
                 .filter(F.col("date").isNotNull()))


CAL_SQL = """
SELECT report_date,
  CAST(year(report_date) AS INTEGER) AS year,
  CAST(month(report_date) AS INTEGER) AS month,
  CAST(day(report_date) AS INTEGER) AS day,
  CAST(dayofweek(report_date) + 1 AS INTEGER) AS weekday,
  ROUND(sin(CAST(6.28318 AS DOUBLE) * CAST(dayofweek(report_date) + 1 AS INTEGER) / 7), 9)
    AS weekday_sin,
  ROUND(cos(CAST(6.28318 AS DOUBLE) * CAST(dayofweek(report_date) + 1 AS INTEGER) / 7), 9)
    AS weekday_cos,
  ROUND(sin(CAST(6.28318 AS DOUBLE) * CAST(month(report_date) AS INTEGER) / 12), 9)
    AS month_sin,
  ROUND(cos(CAST(6.28318 AS DOUBLE) * CAST(month(report_date) AS INTEGER) / 12), 9)
    AS month_cos,
  CASE WHEN report_date IN (SELECT CAST(unnest([{work}]) AS DATE)) THEN 0
       WHEN dayofweek(report_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN report_date IN (SELECT CAST(unnest([{hol}]) AS DATE)) THEN 1 ELSE 0 END AS is_holiday
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders) d
""".replace("{hol}", ", ".join(f"'{d}'" for d in HOLIDAYS)) \
   .replace("{work}", ", ".join(f"'{d}'" for d in WORKDAYS))


@register("calendar_features", CAL_SQL)
def calendar_features(spark, sf_dir):
    """Calendar block per order day (cyclic terms rounded to 1e-9)."""
    d = _order_days(spark, sf_dir)
    cols = cal.calendar_columns("report_date", holidays=HOLIDAYS, workday_overrides=WORKDAYS)
    for c in ("weekday_sin", "weekday_cos", "month_sin", "month_cos"):
        cols[c] = F.round(cols[c], 9)
    return d.select("report_date", *[e.alias(n) for n, e in cols.items()])


@register("weekend_flag", """
SELECT report_date,
  CASE WHEN dayofweek(report_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN report_date IN (SELECT CAST(unnest([{work}]) AS DATE)) THEN 0
       WHEN dayofweek(report_date) IN (5, 6) THEN 1 ELSE 0 END AS is_weekend_fri_sat
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders) d
""".replace("{work}", ", ".join(f"'{d}'" for d in WORKDAYS)))
def weekend_flag(spark, sf_dir):
    """Weekend flag: calendar weekend (Sat, Sun) and the reference's (Fri, Sat) + overrides."""
    d = _order_days(spark, sf_dir)
    return d.select(
        "report_date",
        cal.weekend_flag("report_date", cal.WEEKEND_SUN_SAT).alias("is_weekend"),
        cal.weekend_flag("report_date", cal.WEEKEND_REFERENCE, WORKDAYS)
        .alias("is_weekend_fri_sat"))


@register("holiday_flag", """
SELECT report_date,
  CASE WHEN report_date IN (SELECT CAST(unnest([{hol}]) AS DATE)) THEN 1 ELSE 0 END
    AS is_holiday,
  CASE WHEN strftime(report_date, '%m-%d') IN ({ann}) THEN 1 ELSE 0 END AS is_annual_holiday
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders) d
""".replace("{hol}", ", ".join(f"'{d}'" for d in HOLIDAYS))
   .replace("{ann}", ", ".join(f"'{d}'" for d in ANNUAL_HOLIDAYS)))
def holiday_flag(spark, sf_dir):
    """Holiday flags: the fixed date list (isin) and an annual calendar table (broadcast join)."""
    d = _order_days(spark, sf_dir)
    d = d.withColumn("is_holiday", cal.holiday_flag("report_date", HOLIDAYS))
    return cal.join_holiday_calendar(d, "report_date", annual_holiday_calendar(d),
                                     out="is_annual_holiday")


@register("trend_feature", """
SELECT report_date,
  CAST(datediff('day', DATE '1970-01-01', report_date) AS INTEGER) AS trend_days,
  CAST(datediff('day', DATE '1970-01-01', report_date) AS BIGINT) * 86400 AS trend_seconds,
  CAST(strftime(report_date, '%Y%m%d') AS BIGINT) AS trend_yyyymmdd,
  CAST(epoch(timezone('Asia/Shanghai', report_date::TIMESTAMP)) AS BIGINT)
    AS trend_unix_timestamp
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders) d
""")
def trend_feature(spark, sf_dir):
    """Trend encodings of each order day (days, UTC seconds, yyyyMMdd, and the timestamp
    of local midnight in a fixed zone)."""
    d = _order_days(spark, sf_dir)
    cols = cal.trend_columns("report_date", zone=TREND_ZONE)
    return d.select("report_date", *[e.alias(n) for n, e in cols.items()])


def _lag_sql() -> str:
    cols = ["d.user_id", "d.report_date", "d.value_sum", "d.n_events"]
    joins = []
    for i in lags.DEFAULT_LAGS:
        cols += [f"l{i}.{m} AS {m}_{i}" for m in LAG_MEASURES]
        joins.append(f"LEFT JOIN d l{i} ON l{i}.user_id = d.user_id "
                     f"AND l{i}.report_date = d.report_date - {i}")
    return (f"WITH d AS ({EVENT_DAYS_SQL})\nSELECT " + ", ".join(cols) + "\nFROM d\n"
            + "\n".join(joins))


LAG_SQL = _lag_sql()


@register("lag_features", LAG_SQL)
def lag_features(spark, sf_dir):
    """(user, day) sums with exact-date lags 1..14 of both measures (one Window, no join)."""
    days = event_panel_days(table(spark, sf_dir, "events"))
    return lags.lag_features(days, ["user_id"], "report_date", LAG_MEASURES)


@register("lag_self_join", LAG_SQL)
def lag_self_join(spark, sf_dir):
    """The same lags by exact-date matching, as one shifted union and one group-by (a
    cross-check: 15 rows shuffled for every input row, so never the default path)."""
    days = event_panel_days(table(spark, sf_dir, "events"))
    return lags.lag_self_join(days, ["user_id"], "report_date", LAG_MEASURES)
