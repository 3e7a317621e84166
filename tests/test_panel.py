import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from dayflow.operators import panel

D = dt.date


def test_forward_fill_leading_nulls_and_keys(spark):
    rows = [(1, D(2014, 1, 1), None), (1, D(2014, 1, 2), 5.0), (1, D(2014, 1, 3), None),
            (2, D(2014, 1, 1), 7.0), (2, D(2014, 1, 2), None)]
    df = spark.createDataFrame(rows, "k int, d date, v double")
    out = panel.forward_fill(df, ["k"], "d", ["v"]).orderBy("k", "d").collect()
    assert [r["v"] for r in out] == [None, 5.0, 5.0, 7.0, 7.0]


def test_forward_fill_unknown_column_raises(spark):
    df = spark.createDataFrame([(1, D(2014, 1, 1), 1.0)], "k int, d date, v double")
    with pytest.raises(ValueError):
        panel.forward_fill(df, ["k"], "d", ["mf_daily_yield"])


def test_guarded_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(3, 2), (1, 0), (0, 0)], "m bigint, f bigint")
    got = [r[0] for r in df.select(panel.guarded_ratio(F.col("m"), F.col("f"))).collect()]
    assert got == [1.5, 3.0, 3.0]


def test_left_join_sentinel(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20)], "user_id int, amt int")
    dim = spark.createDataFrame([(1, 0, 11, "Leo")], "user_id int, sex int, city int, c string")
    out = panel.left_join_sentinel(facts, dim, "user_id",
                                   {"sex": 2, "city": 114514, "c": "unknown"})
    r = out.filter("user_id = 2").first()
    assert (r["sex"], r["city"], r["c"]) == (2, 114514, "unknown")


def test_spines_and_horizon_cross_month_end(spark):
    hist = spark.createDataFrame(
        [(1, D(2014, 8, 29), 1.0), (1, D(2014, 8, 31), 2.0), (2, D(2014, 8, 30), 3.0)],
        "k int, d date, v double")
    sp = panel.panel_spine(hist, ["k"], panel.day_range(hist, "d"))
    assert sp.count() == 6
    h = panel.horizon_union(hist, ["k"], "d", 3)
    fut = h.filter(F.col("v").isNull()).orderBy("k", "d").collect()
    assert [r["d"] for r in fut[:3]] == [D(2014, 9, 1), D(2014, 9, 2), D(2014, 9, 3)]
    assert len(fut) == 6
    # per-series end: series 2 ends on Aug 30
    h2 = panel.horizon_rows(hist, ["k"], "d", 2, per_key_end=True).filter("k = 2").collect()
    assert sorted(r["d"] for r in h2) == [D(2014, 8, 31), D(2014, 9, 1)]


def test_date_spine(spark):
    s = panel.date_spine(spark, "2014-02-27", "2014-03-02").collect()
    assert [r[0] for r in s] == [D(2014, 2, 27), D(2014, 2, 28), D(2014, 3, 1), D(2014, 3, 2)]


def test_upsert_bulk_point_overwrite(spark):
    df = spark.createDataFrame([(1, D(2014, 9, 1), decimal.Decimal("1.00")),
                                (1, D(2014, 9, 2), None)], "k int, d date, v decimal(38,2)")
    upd = spark.createDataFrame([(1, D(2014, 9, 2), 7.126)], "k int, d date, v double")
    out = panel.upsert(df, upd, ["k", "d"], ["v"]).orderBy("d").collect()
    assert [r["v"] for r in out] == [decimal.Decimal("1.00"), decimal.Decimal("7.13")]
    assert out[0].__fields__ == ["k", "d", "v"]


def test_segment_counts(spark):
    df = spark.createDataFrame([(D(2014, 1, 1), 1), (D(2014, 1, 1), 0), (D(2014, 1, 1), 2)],
                               "d date, sex int")
    r = panel.segment_counts(df, ["d"], "sex", {"male": 1, "female": 0}).first()
    assert (r["male"], r["female"]) == (1, 1)


def test_dense_panel_equals_spine_join(spark):
    vals = spark.createDataFrame(
        [(1, D(2014, 8, 30), 1.0), (1, D(2014, 9, 2), 2.0), (2, D(2014, 8, 31), 3.0)],
        "k int, d date, v double")
    days = panel.day_range(vals, "d", 0, 1)
    a = panel.dense_panel(vals, ["k"], "d", days, {"v": 0.0})
    b = panel.spine_join(panel.panel_spine(vals, ["k"], days, out="d"), vals, ["k"], "d",
                         {"v": 0.0})
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == 2 * 5
    g = panel.dense_panel(vals.drop("k").groupBy("d").agg({"v": "sum"}), [], "d",
                          panel.day_range(vals, "d"))
    assert g.count() == 4


TWO = "more than one row"


def test_join_daily_series_raises_on_a_second_row_for_a_day(spark):
    p = spark.createDataFrame([(1, D(2014, 1, 1)), (2, D(2014, 1, 1))], "k int, d date")
    dup = spark.createDataFrame([(D(2014, 1, 1), 1.0, 9.0), (D(2014, 1, 1), 5.0, 2.0)],
                                "d date, x double, y double")
    with pytest.raises(Exception, match=TWO):
        panel.join_daily_series(p, [dup], "d").collect()
    one = panel.join_daily_series(p, [dup.limit(1)], "d").collect()
    assert [(r["x"], r["y"]) for r in one] == [(1.0, 9.0)] * 2
    with pytest.raises(ValueError, match="must be a date"):
        panel.join_daily_series(p, [dup.withColumn("d", F.col("d").cast("timestamp"))], "d")


def test_panel_and_upsert_raise_on_second_rows(spark):
    vals = spark.createDataFrame([(1, D(2014, 1, 1), 1.0), (1, D(2014, 1, 1), 5.0)],
                                 "k int, d date, v double")
    days = panel.day_range(vals, "d")
    with pytest.raises(Exception, match=TWO):
        panel.dense_panel(vals, ["k"], "d", days).collect()
    spine = panel.panel_spine(vals, ["k"], days, out="d")
    with pytest.raises(Exception, match=TWO):
        panel.spine_join(spine, vals, ["k"], "d").collect()
    with pytest.raises(Exception, match=TWO):
        panel.upsert(vals.limit(1), vals, ["k", "d"], ["v"]).collect()
