import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayflow.operators import model
from dayflow.sources.models import load_models, save_models

D = dt.date


def test_ols_lag1_matches_numpy(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(3):
        x = rng.normal(size=40)
        y = 2.0 + (k + 0.5) * x + rng.normal(scale=0.1, size=40)
        rows += [(k, float(a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    fits = {r["k"]: r for r in model.ols_lag1(df, ["k"]).collect()}
    for k in range(3):
        sel = [(x, y) for kk, x, y in rows if kk == k]
        slope, icpt = np.polyfit([a for a, _ in sel], [b for _, b in sel], 1)
        assert fits[k]["slope"] == pytest.approx(slope, rel=1e-9)
        assert fits[k]["intercept"] == pytest.approx(icpt, rel=1e-9)
        assert fits[k]["n_obs"] == 40


def test_regression_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    rows = [(float(i), float(i) + (0.5 if i % 2 else -0.3)) for i in range(30)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = model.regression_metrics(df.withColumn("g", F.lit(1)), ["g"]).first()
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    assert m["rmse"] == pytest.approx(ev.setMetricName("rmse").evaluate(df), rel=1e-12)
    assert m["r2"] == pytest.approx(ev.setMetricName("r2").evaluate(df), rel=1e-12)


def test_splits_are_deterministic(spark):
    days = [D(2014, 1, 1) + dt.timedelta(days=i) for i in range(100)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    a = model.split_mod(df, "d").filter("split = 'test'").count()
    assert a == 20
    t = model.split_time(df, "d", 10).filter("split = 'test'").collect()
    assert sorted(r["d"] for r in t) == days[-10:]


def _panel(spark, n_days=60):
    rows = []
    for k in (1, 2):
        for i in range(n_days):
            d = D(2014, 7, 1) + dt.timedelta(days=i)
            rows.append((k, d, 100.0 + 3 * i * k + (i % 7), 50.0 + 2 * i + (i % 3)))
    return spark.createDataFrame(rows, "k int, d date, p double, r double")


def test_fit_save_load_roundtrip(spark, tmp_path):
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 2, 7))
    ff = model.complete_rows(model.feature_frame(_panel(spark), ["k"], "d", spec), spec)
    data = model.assemble(ff, spec)
    models = model.fit_targets(data, spec, model.SLIM_PARAMS)
    coefs = model.coefficients_frame(spark, models, spec)
    assert coefs.count() == 2 * (1 + len(spec.feature_names()))
    root = save_models(models, str(tmp_path / "models"))
    loaded = load_models(root, ["p", "r"])
    for t in ("p", "r"):
        assert np.allclose(loaded[t].coefficients.toArray(), models[t].coefficients.toArray())
    with pytest.raises(FileNotFoundError):
        load_models(root, ["missing_target"])


def test_complete_rows_drop_series_heads(spark):
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1, 14))
    ff = model.complete_rows(model.feature_frame(_panel(spark, 20), ["k"], "d", spec), spec)
    assert ff.count() == 2 * (20 - 14)


def test_ols_residuals_orthogonal_to_features(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=60)
    y = 1.0 + 0.4 * x + rng.normal(scale=0.2, size=60)
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(x, y)],
                               "k int, x double, y double")
    s = model.score_lag1(df, ["k"]).withColumn("res", F.col("y") - F.col("prediction"))
    r = s.agg(F.sum("res").alias("s0"), F.sum(F.col("res") * F.col("x")).alias("s1")).first()
    assert abs(r["s0"]) < 1e-9 and abs(r["s1"]) < 1e-9


def test_unpenalised_fit_residuals_orthogonal(spark):
    rng = np.random.default_rng(11)
    rows = []
    for k in (1, 2, 3):
        for i in range(80):
            rows.append((k, D(2014, 1, 1) + dt.timedelta(days=i),
                         float(rng.normal(100, 10)), float(rng.normal(50, 5))))
    panel = spark.createDataFrame(rows, "k int, d date, p double, r double")
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p", "r"), lags=(1, 2),
                             calendar=("weekday_sin", "month_cos"))
    ff = model.complete_rows(model.feature_frame(panel, ["k"], "d", spec), spec)
    data = model.assemble(ff, spec)
    m = model.fit_targets(data, spec, model.WIDE_PARAMS)["p"]
    pdf = m.transform(data).select("features", "p", "prediction").toPandas()
    X = np.vstack([v.toArray() for v in pdf["features"]])
    res = (pdf["p"] - pdf["prediction"]).to_numpy()
    scale = np.abs(X).max(axis=0) * np.abs(res).max() * len(res)
    assert np.all(np.abs(X.T @ res) <= 1e-6 * scale)
    assert abs(res.sum()) <= 1e-6 * np.abs(res).max() * len(res)


def test_feature_frame_requires_columns(spark):
    spec = model.FeatureSpec(targets=("p", "missing"), lag_measures=("p",), lags=(1,))
    with pytest.raises(ValueError):
        model.feature_frame(_panel(spark), ["k"], "d", spec)


def test_split_random_fraction(spark):
    df = spark.range(20000).select(F.col("id"))
    n = model.split_random(df, 0.2, seed=4254).filter("split = 'test'").count()
    assert 3600 < n < 4400


def test_split_time_on_timestamps(spark):
    import datetime as dt
    rows = [(dt.datetime(2014, 1, 1, 8) + dt.timedelta(days=i),) for i in range(10)]
    df = spark.createDataFrame(rows, "d timestamp")
    out = model.split_time(df, "d", 3)
    assert out.filter("split = 'test'").count() == 3


def test_spec_options_reach_the_features(spark):
    import datetime as dt

    import pytest
    df = spark.createDataFrame([(dt.date(2014, 5, 4), 1.0)], "d date, v double")
    base = dict(targets=("v",), lag_measures=("v",), lags=(1,))
    get = lambda **k: df.select(*[e.alias(n) for n, e in model.FeatureSpec(
        **base, **k).date_terms("d").items()]).first()
    assert get()["is_weekend"] == 1 and get(workday_overrides=("2014-05-04",))["is_weekend"] == 0
    assert get(pi=3.0)["weekday_sin"] != get()["weekday_sin"]
    assert get(trend="trend_unix_timestamp")["trend_unix_timestamp"] is not None
    with pytest.raises(ValueError, match="unknown trend"):
        get(trend="nope")


def test_all_models_score_in_one_scan(spark, tmp_path):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(int(i), *map(float, rng.normal(size=4))) for i in range(60)]
    df = spark.createDataFrame(rows, "d int, a double, b double, x double, z double")
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=["x", "z"], outputCol="features")
    va.transform(df).write.parquet(str(tmp_path / "f"))
    data = spark.read.parquet(str(tmp_path / "f"))
    spec = model.FeatureSpec(targets=("a", "b"), lag_measures=("a",), lags=(1,))
    models = model.fit_targets(data, spec, model.WIDE_PARAMS)
    out = model.score_models(models, data, [], "d")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    for t in ("a", "b"):
        want = {r.d: (r[t], r.prediction) for r in models[t].transform(data).collect()}
        got = {r.d: (r.label, r.prediction) for r in out.filter(out.target == t).collect()}
        assert got == want


def test_feature_arrays_equal_the_assembled_vectors(spark):
    from conftest import SF001
    from dayflow.plans import model_queries as q
    p = q.materialize(q.model_panel(spark, SF001), "panel")
    wide = {(r.c_nationkey, r.report_date): (r.split, r.features.toArray().tolist(), r.purchase)
            for r in q.assembled_features(spark, SF001, p).collect()}
    packed = {(r.c_nationkey, r.report_date): (r.split, r.features, r.purchase)
              for r in q.packed_features(p, q.SPEC, q.KEYS).collect()}
    assert wide == packed
