import datetime as dt
import math


from dayflow.functions import calendar as cal


def test_calendar_columns_match_python(spark):
    days = [dt.date(2014, 5, 1) + dt.timedelta(days=i) for i in range(10)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    cols = cal.calendar_columns("d", holidays=cal.HOLIDAYS_2013_2014)
    rows = df.select("d", *[e.alias(n) for n, e in cols.items()]).orderBy("d").collect()
    for r in rows:
        d = r["d"]
        weekday = d.isoweekday() % 7 + 1          # Spark: 1 = Sunday
        assert r["weekday"] == weekday
        assert math.isclose(r["weekday_sin"], math.sin(2 * 3.14159 * weekday / 7))
        assert math.isclose(r["month_cos"], math.cos(2 * 3.14159 * d.month / 12))
        assert r["is_weekend"] == int(weekday in (1, 7))
        assert r["is_holiday"] == int(str(d) in cal.HOLIDAYS_2013_2014)


def test_reference_weekend_with_overrides(spark):
    # 2014-05-04 is a Sunday working day; 2014-09-26/27 are Fri/Sat
    days = [dt.date(2014, 5, 4), dt.date(2014, 9, 26), dt.date(2014, 9, 27),
            dt.date(2014, 9, 28)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    ref = cal.weekend_flag("d", cal.WEEKEND_REFERENCE, cal.WORKDAY_OVERRIDES_2014)
    got = [r[0] for r in df.select(ref).collect()]
    assert got == [0, 1, 1, 0]


def test_holiday_calendar_join(spark):
    df = spark.createDataFrame([(dt.date(2014, 10, 1),), (dt.date(2014, 10, 8),)], "d date")
    calendar = spark.createDataFrame([(dt.date(2014, 10, 1),)] * 2, "date date")
    out = cal.join_holiday_calendar(df, "d", calendar).orderBy("d").collect()
    assert [r["is_holiday"] for r in out] == [1, 0]


def test_trend_columns(spark):
    df = spark.createDataFrame([(dt.date(1970, 1, 2),), (dt.date(2014, 9, 1),)], "d date")
    rows = df.select(*[e.alias(n) for n, e in cal.trend_columns("d").items()]).collect()
    assert rows[0] == (1, 86400, 19700102)
    assert rows[1]["trend_days"] == (dt.date(2014, 9, 1) - dt.date(1970, 1, 1)).days


def test_trend_session_timestamp_follows_time_zone(spark):
    df = spark.createDataFrame([(dt.date(2014, 9, 1),)], "d date")
    cols = cal.trend_columns("d", session_timestamp=True)
    r = df.select(*[e.alias(n) for n, e in cols.items()]).first()
    assert r["trend_unix_timestamp"] == r["trend_seconds"]        # session zone is UTC
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        r = df.select(*[e.alias(n) for n, e in cols.items()]).first()
        assert r["trend_unix_timestamp"] == r["trend_seconds"] - 8 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_annual_calendar_skips_missing_days(spark):
    from dayflow.plans.feature_queries import annual_holiday_calendar
    days = spark.createDataFrame([(dt.date(2015, 3, 1),), (dt.date(2016, 3, 1),)],
                                 "report_date date")
    got = sorted(r[0] for r in annual_holiday_calendar(days, month_days=("02-29", "01-01"))
                 .collect())
    assert got == [dt.date(2015, 1, 1), dt.date(2016, 1, 1), dt.date(2016, 2, 29)]
