"""Property: the SQL and pandas rollout engines agree on random series
(different lengths, gaps inside the lag window, random coefficients)."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dayflow.operators import model, rollout

obs = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 25),
                         st.floats(-100, 100, allow_nan=False),
                         st.floats(-100, 100, allow_nan=False)),
               min_size=1, max_size=50, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=8, deadline=None)
@given(obs, st.lists(st.floats(-0.5, 0.5, allow_nan=False), min_size=2 * 9, max_size=2 * 9),
       st.integers(1, 6))
def test_sql_and_pandas_engines_agree(spark, rows, w, horizon):
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 2),
                             calendar=("weekday_sin", "month_cos", "is_weekend",
                                       "is_holiday"))
    nf = len(spec.feature_names())                 # trend + 4 calendar + 4 lags = 9
    coefs = {"p": (1.0, w[:nf]), "r": (-2.0, w[nf:])}
    base = dt.date(2014, 8, 20)
    df = spark.createDataFrame([(k, base + dt.timedelta(days=o), a, b) for k, o, a, b in rows],
                               "k int, d date, p double, r double")
    a = {(r["k"], r["d"]): r for r in
         rollout.rollout_linear(df, ["k"], "d", spec, coefs, horizon, engine="sql").collect()}
    b = {(r["k"], r["d"]): r for r in
         rollout.rollout_linear(df, ["k"], "d", spec, coefs, horizon, engine="pandas").collect()}
    assert a.keys() == b.keys()
    for key in a:
        for t in ("p", "r"):
            x, y = a[key][t], b[key][t]
            assert (x is None) == (y is None)
            if x is not None:
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9)
