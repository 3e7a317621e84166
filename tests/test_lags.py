import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from dayflow.operators import lags

D = dt.date


def _gapped(spark):
    rows = []
    for k, n in ((1, 20), (2, 9)):          # two series of different length
        for i in range(n):
            if i in (3, 4, 11):             # gaps inside the series
                continue
            rows.append((k, D(2014, 8, 25) + dt.timedelta(days=i), float(10 * k + i), i))
    return spark.createDataFrame(rows, "k int, d date, a double, b int")


def test_window_lags_equal_self_joins(spark):
    df = _gapped(spark)
    w = lags.lag_features(df, ["k"], "d", ["a", "b"])
    for method in ("shift", "join"):
        j = lags.lag_self_join(df, ["k"], "d", ["a", "b"], method=method)
        assert w.columns == j.columns
        assert sorted(w.collect()) == sorted(j.collect())


def test_shift_self_join_is_one_shuffle(spark):
    df = _gapped(spark)
    plan = lags.lag_self_join(df, ["k"], "d", ["a", "b"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_exact_date_lag_is_null_at_gaps(spark):
    df = _gapped(spark)
    w = lags.lag_features(df, ["k"], "d", ["a"], (1,))
    r = w.filter((F.col("k") == 1) & (F.col("d") == D(2014, 8, 30))).first()  # day 5
    assert r["a_1"] is None                       # day 4 missing -> null
    row_lag = df.withColumn("p", F.lag("a").over(Window.partitionBy("k").orderBy("d")))
    assert row_lag.filter((F.col("k") == 1) & (F.col("d") == D(2014, 8, 30))).first()["p"] == 12.0


def test_window_lags_plan_has_no_join(spark):
    df = _gapped(spark)
    plan = lags.lag_features(df, ["k"], "d", ["a", "b"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Window [") + plan.count("Window(") >= 1
    assert "Exchange hashpartitioning(k" in plan


def test_second_row_for_a_day_raises(spark):
    import datetime as dt

    import pytest
    from dayflow.operators import lags
    df = spark.createDataFrame([(1, dt.date(2014, 1, 1), 1.0), (1, dt.date(2014, 1, 1), 2.0)],
                               "k int, d date, v double")
    for fn in (lags.lag_features, lags.lag_self_join):
        with pytest.raises(Exception, match="more than one row"):
            fn(df, ["k"], "d", ["v"], (1,)).collect()
