import datetime as dt

import numpy as np
import pytest

from dayflow.operators import model, rollout

D = dt.date


def test_rollout_ar1_matches_loop(spark):
    start = spark.createDataFrame([(1, D(2014, 8, 30), 10.0, 1.5, 0.8),
                                   (2, D(2014, 8, 31), -3.0, 0.0, -0.5)],
                                  "k int, d date, y0 double, intercept double, slope double")
    out = rollout.rollout_ar1(start, ["k"], "d", 5).orderBy("k", "step").collect()
    for k, last, y, a, b in [(1, D(2014, 8, 30), 10.0, 1.5, 0.8),
                             (2, D(2014, 8, 31), -3.0, 0.0, -0.5)]:
        got = [r for r in out if r["k"] == k]
        for h, r in enumerate(got, start=1):
            y = a + b * y
            assert r["forecast"] == y            # same operations, same doubles
            assert r["d"] == last + dt.timedelta(days=h)
            assert r["step"] == h


def _brute_force(hist_rows, spec, coefs, horizon):
    """The reference's day-by-day loop: predict all targets of day t from values
    of days < t, write them, move to t + 1."""
    vals = {}
    for d, rec in hist_rows:
        vals[d] = dict(rec)
    last = max(vals)
    out = []
    for h in range(1, horizon + 1):
        d = last + dt.timedelta(days=h)
        weekday = d.isoweekday() % 7 + 1
        cal = {"weekday_sin": np.sin(2 * 3.14159 * weekday / 7),
               "weekday_cos": np.cos(2 * 3.14159 * weekday / 7),
               "month_sin": np.sin(2 * 3.14159 * d.month / 12),
               "month_cos": np.cos(2 * 3.14159 * d.month / 12),
               "is_weekend": float(weekday in (1, 7)), "is_holiday": 0.0}
        x = [float((d - D(1970, 1, 1)).days)] + [cal[c] for c in spec.calendar]
        x += [vals[d - dt.timedelta(days=i)][m] for m in spec.lag_measures for i in spec.lags]
        pred = {t: coefs[t][0] + float(np.dot(coefs[t][1], x)) for t in spec.targets}
        vals[d] = pred
        out.append((d, pred))
    return out


@pytest.mark.parametrize("engine", ["sql", "pandas", "companion"])
@pytest.mark.parametrize("n_days", [20, 33])
def test_rollout_linear_matches_day_by_day_loop(spark, n_days, engine):
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 2, 7))
    rng = np.random.default_rng(7)
    nf = len(spec.feature_names())
    coefs = {"p": (5.0, list(rng.normal(scale=0.05, size=nf))),
             "r": (-2.0, list(rng.normal(scale=0.05, size=nf)))}
    rows, hist = [], {}
    for k, n in ((1, n_days), (2, n_days - 5)):     # series of different length
        hist[k] = []
        for i in range(n):
            d = D(2014, 8, 1) + dt.timedelta(days=i)
            rec = {"p": float(100 + i * k), "r": float(40 - i)}
            rows.append((k, d, rec["p"], rec["r"]))
            hist[k].append((d, rec))
    df = spark.createDataFrame(rows, "k int, d date, p double, r double")
    out = rollout.rollout_linear(df, ["k"], "d", spec, coefs, 12, engine=engine).collect()
    for k in (1, 2):
        got = sorted((r for r in out if r["k"] == k), key=lambda r: r["d"])
        want = _brute_force(hist[k], spec, coefs, 12)
        assert [r["d"] for r in got] == [d for d, _ in want]   # crosses the month end
        for r, (_, p) in zip(got, want):
            assert r["p"] == pytest.approx(p["p"], rel=1e-9)
            assert r["r"] == pytest.approx(p["r"], rel=1e-9)


def test_rollout_linear_requires_lag_measures_as_targets(spark):
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p", "q"), lags=(1,))
    df = spark.createDataFrame([(1, D(2014, 1, 1), 1.0, 1.0)], "k int, d date, p double, q double")
    with pytest.raises(ValueError):
        rollout.rollout_linear(df, ["k"], "d", spec, {"p": (0.0, [0.0] * 9)}, 3)


@pytest.mark.parametrize("engine", ["sql", "pandas", "companion"])
def test_null_when_lag_missing(spark, engine):
    # a gap inside the lag window makes the first forecasts null (exact-date lags)
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1, 3), calendar=(),
                             trend=None)
    rows = [(1, D(2014, 8, 1), 1.0), (1, D(2014, 8, 3), 2.0)]      # Aug 2 missing
    df = spark.createDataFrame(rows, "k int, d date, p double")
    out = rollout.rollout_linear(df, ["k"], "d", spec, {"p": (0.0, [1.0, 1.0])}, 3,
                                 engine=engine)
    got = [r["p"] for r in out.orderBy("d").collect()]
    # Aug 4 reads Aug 3 and Aug 1 -> 3.0; Aug 5 reads Aug 4 and Aug 2 (missing) -> null
    assert got[0] == 3.0 and got[1] is None


def test_engine_is_chosen_by_argument_only(spark):
    df = spark.createDataFrame([(1, D(2014, 1, 1), 1.0)], "k int, d date, p double")
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=tuple(range(1, 3000)))
    coefs = {"p": (0.0, [0.0] * len(spec.feature_names()))}
    plan = lambda e: rollout.rollout_linear(
        df, ["k"], "d", spec, coefs, 2, **e)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan({})
    assert "FlatMapGroupsInPandas" in plan({"engine": "pandas"})
    with pytest.raises(ValueError, match="engine"):
        plan({"engine": "auto"})


ENGINES = ["sql", "pandas", "companion"]


def _wide():
    from dayflow.plans.model_queries import WIDE_SPEC, WIDE_TARGETS
    assert len(WIDE_TARGETS) == 26 and len(WIDE_SPEC.feature_names()) == 371
    rng = np.random.default_rng(3)
    coefs = {t: (float(rng.normal()), list(rng.normal(scale=0.01, size=371)))
             for t in WIDE_TARGETS}
    days = [D(2014, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    vals = rng.normal(size=(20, 26)) * 100
    return WIDE_SPEC, WIDE_TARGETS, coefs, [(d, *map(float, v)) for d, v in zip(days, vals)]


def test_wide_spec_of_one_global_series(spark):
    spec, targets, coefs, rows = _wide()
    df = spark.createDataFrame(rows, "d date, " + ", ".join(f"{t} double" for t in targets))
    sql, *others = ([tuple(r) for r in rollout.rollout_linear(
        df, [], "d", spec, coefs, 3, engine=e).orderBy("d").collect()] for e in ENGINES)
    assert len(sql) == 3
    for other in others:
        assert [r[:2] for r in sql] == [r[:2] for r in other]
        assert np.allclose([r[2:] for r in sql], [r[2:] for r in other])


@pytest.mark.parametrize("engine", ENGINES)
def test_duplicate_days_and_coefficients_raise(spark, engine):
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1,), calendar=(),
                             trend=None)
    df = spark.createDataFrame([(1, D(2014, 1, 1), 1.0), (1, D(2014, 1, 2), 2.0)],
                               "k int, d date, p double")
    ok = rollout.rollout_linear(df, ["k"], "d", spec, {"p": (0.0, [1.0])}, 2, engine=engine)
    assert [r.p for r in ok.orderBy("d").collect()] == [2.0, 2.0]
    wide = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1, 2), calendar=(),
                             trend=None)
    with pytest.raises(Exception, match="more than one row"):
        rollout.rollout_linear(df.union(df), ["k"], "d", wide, {"p": (0.0, [1.0, 1.0])}, 2,
                               engine=engine).collect()
    with pytest.raises(ValueError, match="coefficients"):
        rollout.rollout_linear(df, ["k"], "d", spec, {"p": (0.0, [1.0, 2.0])}, 2, engine=engine)


@pytest.mark.parametrize("engine", ENGINES)
def test_nan_counts_as_null(spark, engine):
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1, 2), calendar=(),
                             trend=None)
    df = spark.createDataFrame([(1, D(2014, 1, 1), 1.0), (1, D(2014, 1, 2), float("nan"))],
                               "k int, d date, p double")
    got = rollout.rollout_linear(df, ["k"], "d", spec, {"p": (0.0, [1.0, 1.0])}, 2, engine=engine)
    assert [r.p for r in got.orderBy("d").collect()] == [None, None]
    assert rollout.rollout_linear(df.filter("false").drop("k"), [], "d", spec,
                                  {"p": (0.0, [1.0, 1.0])}, 2, engine=engine).count() == 0


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("day", [5, 3, 0])      # the last day, the cut of the tail, before it
def test_a_second_row_for_any_day_raises(spark, engine, day):
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1, 2, 3), calendar=(),
                             trend=None)
    days = [(D(2014, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(6)]
    rows = [(k, *d) for k in (1, 2) for d in days]
    coefs = {"p": (0.0, [1.0, 0.5, 0.25])}
    ok = spark.createDataFrame(rows, "k int, d date, p double")
    assert rollout.rollout_linear(ok, ["k"], "d", spec, coefs, 2, engine=engine).count() == 4
    twice = spark.createDataFrame([*rows, (2, days[day][0], 99.0)], "k int, d date, p double")
    with pytest.raises(Exception, match="more than one row"):
        rollout.rollout_linear(twice, ["k"], "d", spec, coefs, 2, engine=engine).collect()


def test_companion_form_equals_the_loop_on_both_shapes(spark):
    """26 x 371 of one series and 4 x 61 of many, 30 days, series of several ends and gaps."""
    from dayflow.plans.model_queries import SPEC
    wide, targets, coefs, rows = _wide()
    hist = [(d, dict(zip(targets, v))) for d, *v in rows]
    df = spark.createDataFrame(rows, "d date, " + ", ".join(f"{t} double" for t in targets))
    got = rollout.rollout_linear(df, [], "d", wide, coefs, 30, engine="companion").orderBy("d")
    want = _brute_force(hist, wide, coefs, 30)
    for r, (d, p) in zip(got.collect(), want, strict=True):
        assert r.d == d and np.allclose([r[t] for t in targets], [p[t] for t in targets],
                                        rtol=1e-8, atol=1e-8)
    rng = np.random.default_rng(8)
    slim = {t: (float(rng.normal()), list(rng.normal(scale=0.03, size=61))) for t in SPEC.targets}
    rows = [(k, D(2014, 1, 1) + dt.timedelta(days=i), *map(float, rng.normal(size=4)))
            for k in range(6) for i in range(20 + k) if (k, i) != (5, 21)]
    df = spark.createDataFrame(rows, "k int, d date, " + ", ".join(
        f"{t} double" for t in SPEC.targets))
    sql, fast = ({(r.k, r.step): r for r in rollout.rollout_linear(
        df, ["k"], "d", SPEC, slim, 30, engine=e).collect()} for e in ("sql", "companion"))
    assert sql.keys() == fast.keys() and any(r[3] is None for r in sql.values())
    for at, r in sql.items():
        for a, b in zip(r[1:], fast[at][1:]):
            assert a == b if not isinstance(a, float) else a == pytest.approx(b, rel=1e-8, abs=1e-9)


def test_powers_are_the_companion_matrixs():
    from dayflow.operators import companion
    rng = np.random.default_rng(2)
    lags = rng.normal(size=(4, 3, 3)) * 0.3
    c = np.zeros((12, 12))
    c[:3], c[3:, :-3] = np.hstack(list(lags)), np.eye(9)
    for h, rows in enumerate(companion.powers(lags, 6)):
        assert np.allclose(rows, np.linalg.matrix_power(c, h)[:3])
