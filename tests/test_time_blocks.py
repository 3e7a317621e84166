import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayflow.operators import time_blocks
from dayflow.operators.lags import lag_features
from dayflow.operators.panel import forward_fill

D = dt.date


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _no_series_in_one_task(df):
    """No window sorts all rows of a series in one task."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], line
        if "Window [" in line:
            assert "__block" in line or "__super" in line, line


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("block", [1, 7, 64])
def test_equal_the_unblocked_forms(spark, keys, block):
    r = random.Random(block)
    days = r.sample(range(-40, 60), 50)          # gaps, days before 1970
    rows = [(k, D(1970, 1, 1) + dt.timedelta(days=d), r.choice([None, None, float(d)]),
             r.choice([None, d])) for k in ((1, 2, None) if keys else (1,)) for d in days]
    df = spark.createDataFrame(rows, "k int, d date, x double, y int")
    fill = time_blocks.blocked_forward_fill(df, keys, "d", ["x", "y"], block)
    assert fill.schema == df.schema
    assert _rows(fill) == _rows(forward_fill(df, keys, "d", ["x", "y"]))
    lags = time_blocks.blocked_lag_features(df, keys, "d", ["x", "y"], (1, 2, 9), block)
    want = lag_features(df, keys, "d", ["x", "y"], (1, 2, 9))
    assert lags.columns == want.columns and _rows(lags) == _rows(want)


def test_a_long_series_on_many_tasks(spark):
    n = 1_000_000
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int"))
    series = spark.range(n).select(
        day.alias("d"), F.when(F.xxhash64("id") % 5000 == 0, F.col("id")).alias("x"),
        F.when(F.col("id") < 10, F.col("id")).alias("rare"), F.col("id"))
    fill = time_blocks.blocked_forward_fill(series, [], "d", ["x", "rare"])
    lags = time_blocks.blocked_lag_features(series, [], "d", ["id"], (1, 14))
    _no_series_in_one_task(fill)
    _no_series_in_one_task(lags)
    plain = forward_fill(series, [], "d", ["x", "rare"])
    assert fill.exceptAll(plain).isEmpty() and fill.count() == n
    assert lags.exceptAll(lag_features(series, [], "d", ["id"], (1, 14))).isEmpty()
    assert lags.filter("id_14 = id - 14 and id_1 = id - 1").count() == n - 14


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-300, 300), st.one_of(st.none(), st.integers(0, 9))),
                max_size=40, unique_by=lambda t: t[0]), st.integers(4, 50))
def test_any_integers_and_blocks(spark, rows, block):
    df = spark.createDataFrame(rows, "o long, v int")
    assert _rows(time_blocks.blocked_forward_fill(df, [], "o", ["v"], block)) == \
        _rows(forward_fill(df, [], "o", ["v"]))
    got = {r.o: r.v_3 for r in time_blocks.blocked_lag_features(
        df, [], "o", ["v"], (3,), block).collect()}
    by = dict(rows)
    assert got == {o: by.get(o - 3) for o, _ in rows}


def test_timestamps_nulls_and_empty_tables(spark):
    t = lambda s: dt.datetime(2020, 1, 1) + dt.timedelta(seconds=s)
    df = spark.createDataFrame([(t(0), 1), (t(5), None), (None, 7), (t(9000), None)],
                               "t timestamp, v int")
    for frame in (df, df.withColumn("t", F.col("t").cast("timestamp_ntz"))):
        got = time_blocks.blocked_forward_fill(frame, [], "t", ["v"], 60)
        assert [r.v for r in got.orderBy("t").collect()] == [7, 1, 1, 1]
        lags = time_blocks.blocked_lag_features(frame, [], "t", ["v"], (5,), 3)
        assert [r.v_5 for r in lags.orderBy("t").collect()] == [None, None, 1, None]
    empty = df.limit(0)
    assert time_blocks.blocked_forward_fill(empty, [], "t", ["v"]).count() == 0
    assert time_blocks.blocked_lag_features(empty, [], "t", ["v"]).count() == 0


def test_two_rows_unknown_columns_and_orders_without_units_raise(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "b")], "o int, v double, s string")
    with pytest.raises(Exception, match="more than one row"):
        time_blocks.blocked_lag_features(df, [], "o", ["v"], (1,)).collect()
    with pytest.raises(ValueError, match="unknown"):
        time_blocks.blocked_forward_fill(df, [], "o", ["w"])
    with pytest.raises(ValueError, match="units"):
        time_blocks.blocked_lag_features(df, [], "s", ["v"])
