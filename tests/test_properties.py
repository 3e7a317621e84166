"""Property tests: pushable date predicates equal the string-prefix semantics."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayflow.operators import filters

days = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


@settings(max_examples=15, deadline=None)
@given(st.lists(days, min_size=1, max_size=40), days)
def test_month_filter_equals_substr_rule(spark, sample, probe):
    month = probe.strftime("%Y%m")
    df = spark.createDataFrame([(d,) for d in sample], "d date") \
        .withColumn("s", F.date_format("d", "yyyyMMdd"))
    want = sorted(d for d in sample if d.strftime("%Y%m%d")[:6] == month)
    for col in ("d", "s"):
        got = sorted(r["d"] for r in filters.month_filter(df, col, month).collect())
        assert got == want
    got = sorted(r["d"] for r in filters.prefix_filter(df, "d", month[:4]).collect())
    assert got == sorted(d for d in sample if d.year == probe.year)


@given(st.integers(min_value=1, max_value=9998), st.integers(min_value=1, max_value=12))
def test_month_bounds_half_open(y, m):
    start, end = filters.month_bounds(f"{y:04d}{m:02d}")
    assert start.day == 1 and end.day == 1
    assert (end - dt.timedelta(days=1)).month == m
