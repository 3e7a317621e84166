"""Property: window lags equal self-join lags on random gapped multi-series data."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from dayflow.operators import lags

series = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 40), st.integers(-50, 50)),
    min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=10, deadline=None)
@given(series, st.lists(st.integers(1, 10), min_size=1, max_size=4, unique=True))
def test_window_lags_equal_self_join(spark, rows, lag_set):
    base = dt.date(2014, 8, 20)
    df = spark.createDataFrame([(k, base + dt.timedelta(days=o), float(v)) for k, o, v in rows],
                               "k int, d date, v double")
    a = lags.lag_features(df, ["k"], "d", ["v"], tuple(lag_set)).collect()
    for method in ("shift", "join"):
        b = lags.lag_self_join(df, ["k"], "d", ["v"], tuple(lag_set), method=method).collect()
        assert sorted(a) == sorted(b)
