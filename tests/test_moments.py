"""Shared sufficient statistics, fits of many targets, and certificates."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from dayflow.operators import certificates, model, moments, rollout

from conftest import SF001

D = dt.date


def _frame(spark, x, y, split=None):
    names = [f"t{j}" for j in range(y.shape[1])]
    rows = [(Vectors.dense(a.tolist()), *map(float, b), str(s)) for a, b, s in zip(
        x, y, split if split is not None else ["train"] * len(x))]
    df = spark.createDataFrame(rows, ["features", *names, "split"]).repartition(5)
    return df, names


def _data(n=200, d=7, t=3, seed=1):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, d)) * np.geomspace(1, 1e5, d) + np.geomspace(1e3, 1, d)
    y = x @ g.normal(size=(d, t)) + g.normal(size=(n, t)) * 50 + 1e4
    return x, y


def test_statistics_are_numpys(spark):
    x, y = _data()
    split = np.where(np.arange(200) % 4 == 0, "test", "train")
    df, names = _frame(spark, x, y, split)
    got = moments.moments(df, "features", 7, names, by="split")
    z = np.hstack([x, y])
    for part in ("train", "test"):
        rows = z[split == part]
        assert got[part].n == len(rows)
        assert np.allclose(got[part].mean, rows.mean(0), rtol=1e-13)
        c = rows - rows.mean(0)
        scale = np.sqrt(np.outer((c * c).sum(0), (c * c).sum(0)))
        assert (np.abs(got[part].scatter - c.T @ c) <= 1e-10 * scale).all()


def test_tree_merges_many_sets(spark, monkeypatch):
    monkeypatch.setattr(moments, "MERGED", 2)
    x, y = _data()
    df, names = _frame(spark, x, y)
    got = moments.moments(df.repartition(9), "features", 7, names)[""]
    z = np.hstack([x, y])
    assert got.n == 200 and np.allclose(got.scatter, np.cov(z.T, bias=True) * 200, rtol=1e-8)


@pytest.mark.parametrize("reg", [0.0, 0.1, 30.0])
def test_fit_equals_spark_ml(spark, reg):
    from pyspark.ml.regression import LinearRegression
    x, y = _data()
    df, names = _frame(spark, x, y)
    coefs = moments.fit(moments.moments(df, "features", 7, names)[""], 7, names, reg)
    for t in names:
        m = LinearRegression(labelCol=t, regParam=reg, maxIter=80, tol=1e-5).fit(df)
        assert np.allclose(coefs[t][1], m.coefficients.toArray(), rtol=1e-6)
        assert coefs[t][0] == pytest.approx(m.intercept, rel=1e-6)


def test_no_variance_and_collinear_features(spark):
    x, y = _data()
    x[:, 3] = 5.0                        # constant
    x[:, 4] = 2 * x[:, 0] + x[:, 1]      # collinear
    y[:, 1] = 9.0                        # constant target
    df, names = _frame(spark, x, y)
    coefs = moments.fit(moments.moments(df, "features", 7, names)[""], 7, names)
    assert coefs["t1"] == (pytest.approx(9.0), [0.0] * 7) and coefs["t0"][1][3] == 0.0
    want = np.linalg.lstsq(np.hstack([np.ones((200, 1)), x]), y[:, 0], rcond=None)[0]
    got = coefs["t0"][0] + x @ coefs["t0"][1]
    assert np.allclose(got, np.hstack([np.ones((200, 1)), x]) @ want, rtol=1e-5)


def test_metrics_without_scoring(spark):
    x, y = _data()
    df, names = _frame(spark, x, y)
    stats = moments.moments(df, "features", 7, names)[""]
    coefs = moments.fit(stats, 7, names, 0.5)
    for j, (t, (n, rmse, r2)) in enumerate(moments.metrics(stats, coefs, 7).items()):
        r = y[:, j] - coefs[t][0] - x @ coefs[t][1]
        assert n == 200 and rmse == pytest.approx(np.sqrt((r * r).mean()), rel=1e-9)
        assert r2 == pytest.approx(1 - (r * r).sum() / ((y[:, j] - y[:, j].mean()) ** 2).sum(),
                                   rel=1e-9)


def test_incomplete_rows_and_no_rows_raise(spark):
    x, y = _data(20)
    y[3, 1] = np.nan
    df, names = _frame(spark, x, y)
    with pytest.raises(Exception, match="complete"):
        moments.moments(df, "features", 7, names)
    assert moments.moments(df.limit(0), "features", 7, names) == {}
    with pytest.raises(ValueError, match="no rows"):
        moments.fit(moments.Moments(0, np.zeros(2), np.zeros((2, 2))), 1, ["t"])


def test_reference_shapes_equal_spark_ml(spark):
    """4 targets x 61 features and 26 x 371, on whole tables, from one scan each."""
    from dayflow.plans import model_queries as q
    for spec, data, reg in (
            (q.SPEC, q.assembled_features(spark, SF001), 0.1),
            (q.WIDE_SPEC, q.wide_features(spark, SF001), 0.0)):
        n = len(spec.feature_names())
        as_vector = data.withColumn("features", array_to_vector(
            moments.as_array(data, "features")))
        train = as_vector.filter("split = 'train'")
        opt = moments.state_rows(data, "features", n, spec.targets, "split")
        assert opt._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        coefs = q.one_pass_fit(data, spec, reg)
        some = spec.targets[:4]
        models = model.fit_targets(train, spec.__class__(**{**spec.__dict__, "targets": some}),
                                   {"regParam": reg, "maxIter": 80, "tol": 1e-9})
        test = as_vector.filter("split = 'test'").limit(200).collect()
        x = np.array([r.features.toArray() for r in test])
        for t in some:
            want = x @ models[t].coefficients.toArray() + models[t].intercept
            got = x @ np.array(coefs[t][1]) + coefs[t][0]
            spread = np.std([r[t] for r in test]) or 1.0
            assert np.abs(got - want).max() <= 1e-6 * spread, t


def test_predictions_column(spark):
    x, y = _data(30)
    df, names = _frame(spark, x, y)
    coefs = moments.fit(moments.moments(df, "features", 7, names)[""], 7, names)
    p = moments.predictions(coefs, moments.as_array(df, "features"))
    for r in df.select("features", *[c.alias(t) for t, c in p.items()]).collect():
        for t in names:
            assert r[t] == pytest.approx(coefs[t][0] + r.features.toArray() @ coefs[t][1], rel=1e-9)


def test_perturbed_coefficients_fail_the_certificate(spark):
    x, y = _data()
    split = np.where(np.arange(200) % 4 == 0, "test", "train")
    df, names = _frame(spark, x, y, split)
    stats = moments.moments(df, "features", 7, names, by="split")
    for reg in (0.0, 0.7):
        coefs = moments.fit(stats["train"], 7, names, reg)
        said = moments.metrics(stats["test"], coefs, 7)
        ok = certificates.certify_fit(df, "features", coefs, reg_param=reg, reported=said)
        assert ok == [(t, 150, 50, True, True) for t in names]
        for k in range(7):
            bad = [*coefs["t1"][1]]
            bad[k] += 1e-5 * y[:, 1].std() / x[:, k].std()
            got = certificates.certify_fit(df, "features", {**coefs, "t1": (coefs["t1"][0], bad)},
                                           reg_param=reg, reported=said)
            assert [r[3] for r in got] == [True, False, True], k
        off = {**coefs, "t2": (coefs["t2"][0] * 1.01, coefs["t2"][1])}
        assert not certificates.certify_fit(df, "features", off, reg_param=reg)[2][3]
        wrong = {**said, "t0": (50, said["t0"][1] * 1.001, said["t0"][2])}
        got = certificates.certify_fit(df, "features", coefs, reg_param=reg, reported=wrong)
        assert [r[4] for r in got] == [False, True, True]
    # a ridge fit is none of the plain problem
    assert not certificates.certify_fit(df, "features", moments.fit(stats["train"], 7, names, 5.0)
                                        )[0][3]


@pytest.mark.parametrize("keys", [["k"], []])
def test_changed_forecasts_fail_the_certificate(spark, keys):
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 3))
    g = np.random.default_rng(5)
    n = len(spec.feature_names())
    coefs = {t: (float(g.normal()), list(g.normal(scale=0.2, size=n))) for t in spec.targets}
    rows = [(k, D(2014, 1, 1) + dt.timedelta(days=i), float(g.normal()), float(g.normal()))
            for k in (range(3) if keys else [0]) for i in range(9)]
    hist = spark.createDataFrame(rows, "k int, d date, p double, r double")
    fc = rollout.rollout_linear(hist, keys, "d", spec, coefs, 6)
    whole = {r.target: r for r in certificates.certify_forecast(
        hist, fc, keys, "d", spec, coefs).collect()}
    series = 3 if keys else 1
    for t in spec.targets:
        assert whole[t][1:] == (series, 6 * series, D(2014, 1, 10), D(2014, 1, 15), 6 * series)
    bad = fc.withColumn("p", F.when(F.col("step") == 2, F.col("p") + 1e-2).otherwise(F.col("p")))
    got = {r.target: r.n_hold for r in certificates.certify_forecast(
        hist, bad, keys, "d", spec, coefs).collect()}
    assert got["p"] < 6 * series and got["r"] < 6 * series      # r reads p's changed lag
    none = fc.withColumn("r", F.when(F.col("step") == 6, F.lit(None)).otherwise(F.col("r")))
    got = {r.target: r.n_hold for r in certificates.certify_forecast(
        hist, none, keys, "d", spec, coefs).collect()}
    assert got == {"p": 6 * series, "r": 5 * series}
