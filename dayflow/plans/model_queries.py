"""Modelling and forecasting queries over the (nation, day) purchase / redeem panel.

The panel is dense: every nation x every day of the global range, 0 where a
nation has no orders that day, so exact-date lags are defined everywhere but
the first days of each series.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY_SUM, cents, cents_sum, to_day
from dayflow.functions.fmt import yyyymmdd
from dayflow.operators import certificates, model, moments, panel, rollout
from dayflow.operators.lags import lag_features
from dayflow.plans import jobs
from dayflow.plans.inputs import nation_daily, table, weekday_exog
from dayflow.plans.feature_queries import DATA_HOLIDAYS
from dayflow.plans.panel_queries import EXOG_COLUMNS, NATION_DAILY_SQL, exog_sql
from dayflow.plans.registry import register
from dayflow.session import materialize, scratch_path
from dayflow.sources.files import read_csv, write_csv
from dayflow.sources.models import load_models, save_models

KEYS = ["c_nationkey"]
TARGETS = ("purchase", "redeem")          # the flows (per-series AR queries, extract)
EXOG = ("avg_discount", "avg_tax")        # business-day series, forward filled
HORIZON = 30
SPLIT_K = 5           # one day in five is held out
HOLDOUT_DAYS = 60     # time split: the last 60 days
# The multi-feature models have the reference's slim shape: 4 targets (2 flows
# + 2 exogenous daily series), trend + 4 calendar terms + 14 lags of every
# target = 61 features.
SPEC = model.FeatureSpec(targets=TARGETS + EXOG, lag_measures=TARGETS + EXOG,
                         calendar=("weekday_sin", "month_sin", "is_weekend", "is_holiday"),
                         holidays=DATA_HOLIDAYS)
# The reference's wide shape: 26 targets of one global series, trend + 6 calendar
# terms + 14 lags of every target = 371 features.
WIDE_EXOG = {"avg_discount": "l_discount", "avg_tax": "l_tax", "avg_quantity": "l_quantity"}
WIDE_LINES = tuple(f"{m}_{f}" for f in ("a", "n", "r", "f")
                   for m in ("quantity", "price", "discount", "tax"))
WIDE_ORDERS = ("purchase", "redeem", "n_orders", "priority_1", "priority_2", "priority_3",
               "priority_4")
WIDE_TARGETS = WIDE_LINES + WIDE_ORDERS + tuple(WIDE_EXOG)
WIDE_SPEC = model.FeatureSpec(targets=WIDE_TARGETS, lag_measures=WIDE_TARGETS,
                              holidays=DATA_HOLIDAYS)
# Two features and no penalty: a fit that SQL can solve, so the whole job has an oracle.
SMALL_SPEC = model.FeatureSpec(targets=TARGETS, lag_measures=TARGETS, lags=(1,), calendar=(),
                               trend=None)
# Documented fixed coefficients of the rollout check: weekend, lags 1, 2, 7 of both.
FIXED_SPEC = model.FeatureSpec(targets=TARGETS, lag_measures=TARGETS, lags=(1, 2, 7),
                               calendar=("is_weekend",), trend=None)
FIXED_COEFS = {"purchase": (1000.0, [-250.0, 0.25, 0.125, 0.25, 0.0625, -0.125, 0.0]),
               "redeem": (500.0, [125.0, 0.0625, 0.0, -0.125, 0.25, 0.25, 0.125])}

# --- oracle fragments -------------------------------------------------------
NATION_PANEL_SQL = f"""
WITH nd AS ({NATION_DAILY_SQL}),
sp AS (
  SELECT n.c_nationkey, CAST(g.d AS DATE) AS report_date
  FROM (SELECT DISTINCT c_nationkey FROM nd) n
  CROSS JOIN (SELECT unnest(generate_series((SELECT MIN(report_date) FROM nd),
                                            (SELECT MAX(report_date) FROM nd),
                                            INTERVAL 1 DAY)) AS d) g)
SELECT sp.c_nationkey, sp.report_date,
       COALESCE(nd.purchase, 0) AS purchase, COALESCE(nd.redeem, 0) AS redeem
FROM sp LEFT JOIN nd ON sp.c_nationkey = nd.c_nationkey AND sp.report_date = nd.report_date
"""

LONG_SQL = f"""
WITH np AS ({NATION_PANEL_SQL})
SELECT a.c_nationkey, a.report_date, 'purchase' AS target,
       CAST(a.purchase AS DOUBLE) AS y, CAST(b.purchase AS DOUBLE) AS x
FROM np a LEFT JOIN np b
  ON b.c_nationkey = a.c_nationkey AND b.report_date = a.report_date - 1
UNION ALL
SELECT a.c_nationkey, a.report_date, 'redeem' AS target,
       CAST(a.redeem AS DOUBLE) AS y, CAST(b.redeem AS DOUBLE) AS x
FROM np a LEFT JOIN np b
  ON b.c_nationkey = a.c_nationkey AND b.report_date = a.report_date - 1
"""

FITS_SQL = f"""
SELECT c_nationkey, target, COUNT(x) AS n_obs, regr_slope(y, x) AS slope,
       regr_intercept(y, x) AS intercept
FROM ({LONG_SQL}) l GROUP BY c_nationkey, target
"""

SCORE_SQL = f"""
SELECT l.c_nationkey, l.target, l.report_date, l.y,
       f.intercept + f.slope * l.x AS prediction
FROM ({LONG_SQL}) l JOIN ({FITS_SQL}) f
  ON l.c_nationkey = f.c_nationkey AND l.target = f.target
"""

ROLLOUT_SQL = f"""
WITH RECURSIVE
f AS ({FITS_SQL}),
s AS (
  SELECT l.c_nationkey, l.target, l.report_date, l.y
  FROM ({LONG_SQL}) l
  WHERE l.report_date = (SELECT MAX(report_date) FROM ({NATION_DAILY_SQL}) nd)),
r(c_nationkey, target, step, report_date, y) AS (
  SELECT c_nationkey, target, 0, report_date, y FROM s
  UNION ALL
  SELECT r.c_nationkey, r.target, r.step + 1, r.report_date + 1, f.intercept + f.slope * r.y
  FROM r JOIN f ON r.c_nationkey = f.c_nationkey AND r.target = f.target
  WHERE r.step < {HORIZON})
SELECT c_nationkey, target, CAST(step AS INTEGER) AS step, CAST(report_date AS DATE)
       AS report_date, y AS forecast
FROM r WHERE step > 0
"""

EXTRACT_SQL = f"""
SELECT c_nationkey, strftime(report_date, '%Y%m%d') AS report_date,
       CAST(TRUNC(MAX(CASE WHEN target = 'purchase' THEN forecast END)) AS BIGINT) AS purchase,
       CAST(TRUNC(MAX(CASE WHEN target = 'redeem' THEN forecast END)) AS BIGINT) AS redeem
FROM ({ROLLOUT_SQL}) r GROUP BY c_nationkey, report_date
"""


# --- spark side ---------------------------------------------------------------
def nation_daily_table(spark, sf_dir):
    """The (nation, day) totals, written once below the shared checkpoint root.

    The table is small (series x days) while its input is the whole orders x
    customer join; materialising cuts the lineage so the day range, the spine
    and the fits read it instead of re-running that aggregation.
    """
    nd = nation_daily(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    return materialize(nd, "nation-daily")


def nation_panel(spark, sf_dir):
    """Dense (nation, day) panel of purchase / redeem totals."""
    nd = nation_daily_table(spark, sf_dir)
    return panel.dense_panel(nd, KEYS, "report_date", panel.day_range(nd, "report_date"),
                             {"purchase": 0, "redeem": 0})


def model_panel(spark, sf_dir):
    """Dense (nation, day) flows + the two business-day series, forward filled
    per nation.  The daily series are broadcast (one row per day) and the
    window reuses the panel's nation partitioning."""
    p = panel.join_daily_series(
        nation_panel(spark, sf_dir),
        [weekday_exog(table(spark, sf_dir, "lineitem"), EXOG_COLUMNS)], "report_date")
    return panel.forward_fill(p, KEYS, "report_date", list(EXOG))


def _long(spark, sf_dir, panel_df=None):
    panel_df = panel_df if panel_df is not None else nation_panel(spark, sf_dir)
    p = lag_features(panel_df, KEYS, "report_date", TARGETS, (1,))
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y"),
                               F.col(f"{t}_1").cast("double").alias("x")) for t in TARGETS])
    return p.select(*KEYS, "report_date", F.explode(pairs).alias("p")).select(
        *KEYS, "report_date", "p.target", "p.y", "p.x")


def _fits(long_df):
    return model.ols_lag1(long_df, [*KEYS, "target"])


def _scored(spark, sf_dir):
    # fit and score in one pass: the fit is a window aggregate over the whole
    # series partition, so no aggregate-then-join-back is needed
    return model.score_lag1(_long(spark, sf_dir), [*KEYS, "target"]).select(
        *KEYS, "target", "report_date", "y", "prediction")


def _rollout_ar(spark, sf_dir, panel_df=None):
    # one aggregate per series gives the fit, the last day and its value
    start = model.ols_lag1(_long(spark, sf_dir, panel_df), [*KEYS, "target"],
                           last_day="report_date")
    return rollout.rollout_ar1(start, [*KEYS, "target"], "report_date", HORIZON)


@register("ols_per_series", f"""
SELECT c_nationkey, target, n_obs, ROUND(slope, 9) AS slope, ROUND(intercept, 4) AS intercept
FROM ({FITS_SQL}) f
""")
def ols_per_series(spark, sf_dir):
    """Per (nation, target): OLS of the day's total on the previous day's."""
    f = _fits(_long(spark, sf_dir))
    return f.select(*KEYS, "target", "n_obs", F.round("slope", 9).alias("slope"),
                    F.round("intercept", 4).alias("intercept"))


@register("score", f"""
SELECT c_nationkey, target, report_date, y, ROUND(prediction, 2) AS prediction
FROM ({SCORE_SQL}) s
""")
def score(spark, sf_dir):
    """In-sample predictions of the per-series models (cents)."""
    s = _scored(spark, sf_dir)
    return s.withColumn("prediction", F.round("prediction", 2))


EVAL_SQL = f"""
SELECT c_nationkey, target, COUNT(prediction) AS n,
  sqrt(AVG((y - prediction) * (y - prediction))) AS rmse,
  CASE WHEN VAR_POP(CASE WHEN prediction IS NOT NULL THEN y END) * COUNT(prediction) > 0
       THEN 1 - SUM((y - prediction) * (y - prediction))
                / (VAR_POP(CASE WHEN prediction IS NOT NULL THEN y END) * COUNT(prediction))
  END AS r2
FROM ({SCORE_SQL}) s GROUP BY c_nationkey, target
"""


def _metrics(spark, sf_dir):
    return model.regression_metrics(_scored(spark, sf_dir), [*KEYS, "target"], "y",
                                    "prediction")


@register("eval_rmse", f"SELECT c_nationkey, target, n, ROUND(rmse, 4) AS rmse FROM ({EVAL_SQL}) e")
def eval_rmse(spark, sf_dir):
    """Per-series RMSE of the lag-1 models."""
    m = _metrics(spark, sf_dir)
    return m.select(*KEYS, "target", "n", F.round("rmse", 4).alias("rmse"))


@register("eval_r2", f"SELECT c_nationkey, target, n, ROUND(r2, 9) AS r2 FROM ({EVAL_SQL}) e")
def eval_r2(spark, sf_dir):
    """Per-series R2 of the lag-1 models."""
    m = _metrics(spark, sf_dir)
    return m.select(*KEYS, "target", "n", F.round("r2", 9).alias("r2"))


@register("rollout_ar", f"""
SELECT c_nationkey, target, step, report_date, ROUND(forecast, 2) AS forecast
FROM ({ROLLOUT_SQL}) r
""")
def rollout_ar(spark, sf_dir):
    """30-day recursive forecast of every (nation, target) series."""
    r = _rollout_ar(spark, sf_dir)
    return r.withColumn("forecast", F.round("forecast", 2))


def _extract(spark, sf_dir):
    r = _rollout_ar(spark, sf_dir)
    wide = r.groupBy(*KEYS, "report_date").agg(*[
        F.max(F.when(F.col("target") == t, F.col("forecast"))).alias(t) for t in TARGETS])
    return wide.select(*KEYS, yyyymmdd("report_date").alias("report_date"),
                       *[F.col(t).cast("bigint").alias(t) for t in TARGETS])


@register("extract_horizon", EXTRACT_SQL)
def extract_horizon(spark, sf_dir):
    """Horizon rows as (nation, yyyyMMdd, purchase bigint, redeem bigint)."""
    return _extract(spark, sf_dir)


@register("sink_submission", EXTRACT_SQL)
def sink_submission(spark, sf_dir):
    """The horizon extract written as a headerless CSV, read back with its schema."""
    path = scratch_path(spark, "submission")
    write_csv(_extract(spark, sf_dir), path, mode="errorifexists", header=False)
    return read_csv(spark, path, "c_nationkey int, report_date string, purchase bigint, "
                                 "redeem bigint", header=False)


@register("point_overwrite", f"""
WITH h AS (
  SELECT c_nationkey, report_date, purchase, redeem FROM ({NATION_PANEL_SQL}) p
  UNION ALL
  SELECT n.c_nationkey, CAST(g.d AS DATE), CAST(NULL AS DECIMAL(38,2)), CAST(NULL AS DECIMAL(38,2))
  FROM (SELECT DISTINCT c_nationkey FROM ({NATION_DAILY_SQL}) x) n
  CROSS JOIN (SELECT unnest(generate_series(
      (SELECT MAX(report_date) FROM ({NATION_DAILY_SQL}) y) + INTERVAL 1 DAY,
      (SELECT MAX(report_date) FROM ({NATION_DAILY_SQL}) z) + INTERVAL {HORIZON} DAY,
      INTERVAL 1 DAY)) AS d) g),
f AS (
  SELECT c_nationkey, report_date,
    MAX(CASE WHEN target = 'purchase' THEN ROUND(forecast, 2) END) AS purchase,
    MAX(CASE WHEN target = 'redeem' THEN ROUND(forecast, 2) END) AS redeem
  FROM ({ROLLOUT_SQL}) r GROUP BY c_nationkey, report_date)
SELECT h.c_nationkey, h.report_date,
  CASE WHEN f.c_nationkey IS NOT NULL THEN CAST(f.purchase AS DECIMAL(38,2)) ELSE h.purchase END
    AS purchase,
  CASE WHEN f.c_nationkey IS NOT NULL THEN CAST(f.redeem AS DECIMAL(38,2)) ELSE h.redeem END
    AS redeem
FROM h LEFT JOIN f ON h.c_nationkey = f.c_nationkey AND h.report_date = f.report_date
""")
def point_overwrite(spark, sf_dir):
    """History + horizon placeholders, with forecasts written into the horizon rows."""
    # the panel feeds the history, the horizon keys / days and the rollout:
    # materialise it once instead of re-running its lineage for each use
    p = materialize(nation_panel(spark, sf_dir), "nation-panel")
    hist = panel.horizon_union(p, KEYS, "report_date", HORIZON)
    r = _rollout_ar(spark, sf_dir, p).withColumn("forecast", F.round("forecast", 2))
    upd = r.groupBy(*KEYS, "report_date").agg(*[
        F.max(F.when(F.col("target") == t, F.col("forecast"))).alias(t) for t in TARGETS])
    return panel.upsert(hist, upd, [*KEYS, "report_date"], list(TARGETS))


# --- splits -------------------------------------------------------------------
def _split_summary(df):
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.countDistinct(*KEYS).alias("n_series"),
                                   F.min("report_date").alias("first_day"),
                                   F.max("report_date").alias("last_day"))


@register("split_mod", f"""
SELECT CASE WHEN datediff('day', DATE '1970-01-01', report_date) % {SPLIT_K} = 0
            THEN 'test' ELSE 'train' END AS split,
       COUNT(*) AS n_rows, COUNT(DISTINCT c_nationkey) AS n_series,
       MIN(report_date) AS first_day, MAX(report_date) AS last_day
FROM ({NATION_DAILY_SQL}) nd GROUP BY 1
""")
def split_mod(spark, sf_dir):
    """Deterministic day-modulo train / test split of the (nation, day) rows."""
    nd = nation_daily_table(spark, sf_dir)
    return _split_summary(model.split_mod(nd, "report_date", SPLIT_K))


@register("split_time", f"""
SELECT CASE WHEN report_date > (SELECT MAX(report_date) FROM ({NATION_DAILY_SQL}) m)
                                - {HOLDOUT_DAYS}
            THEN 'test' ELSE 'train' END AS split,
       COUNT(*) AS n_rows, COUNT(DISTINCT c_nationkey) AS n_series,
       MIN(report_date) AS first_day, MAX(report_date) AS last_day
FROM ({NATION_DAILY_SQL}) nd GROUP BY 1
""")
def split_time(spark, sf_dir):
    """Time holdout: the last 60 days are the test set."""
    nd = nation_daily_table(spark, sf_dir)
    return _split_summary(model.split_time(nd, "report_date", HOLDOUT_DAYS))


# --- Spark ML multi-feature models ---------------------------------------------
CONFIGS = {"wide": model.WIDE_PARAMS, "slim": model.SLIM_PARAMS}


def assembled_features(spark, sf_dir, panel_df=None, spec=SPEC, keys=KEYS):
    """Feature frame (trend + calendar + lags of all targets), complete rows,
    split label, assembled vector; materialised once so the per-target fits read
    a written table instead of re-running the lineage."""
    panel_df = panel_df if panel_df is not None else model_panel(spark, sf_dir)
    ff = model.feature_frame(panel_df, keys, "report_date", spec)
    ff = model.split_mod(model.complete_rows(ff, spec), "report_date", SPLIT_K)
    out = model.assemble(ff, spec).select(*keys, "report_date", "split", "features",
                                          *spec.targets)
    return materialize(out, "features")


def packed_features(panel_df, spec, keys):
    """The same rows as :func:`assembled_features` with the features as one array."""
    ff = model.feature_arrays(panel_df, keys, "report_date", spec)
    return materialize(model.split_mod(ff, "report_date", SPLIT_K), "features")


def fit_config(spark, sf_dir, config="slim", panel_df=None):
    data = assembled_features(spark, sf_dir, panel_df)
    models = model.fit_targets(data.filter(F.col("split") == "train"), SPEC, CONFIGS[config])
    return data, models


def _features_sql() -> str:
    """The feature frame as SQL: panel, forward-filled series, date terms, lags as rows
    before (the panel is dense, so the i-th row before is the i-th day before); complete
    rows only."""
    lag_cols = [f"CAST(lag(p.{m}, {i}) OVER d AS DOUBLE) AS {m}_{i}" for m in SPEC.lag_measures
                for i in SPEC.lags]
    complete = " AND ".join(f"{n} IS NOT NULL" for n in SPEC.lag_columns())
    days = ", ".join(f"DATE '{d}'" for d in SPEC.holidays)
    return f"""
WITH np AS ({NATION_PANEL_SQL}),
mp AS (
  SELECT p.c_nationkey, p.report_date, p.purchase, p.redeem,
    LAST_VALUE(x1.avg_discount IGNORE NULLS) OVER w AS avg_discount,
    LAST_VALUE(x2.avg_tax IGNORE NULLS) OVER w AS avg_tax
  FROM np p
  LEFT JOIN ({exog_sql('l_discount', 'avg_discount')}) x1 ON p.report_date = x1.report_date
  LEFT JOIN ({exog_sql('l_tax', 'avg_tax')}) x2 ON p.report_date = x2.report_date
  WINDOW w AS (PARTITION BY p.c_nationkey ORDER BY p.report_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ff AS (
  SELECT p.c_nationkey, p.report_date,
    CASE WHEN datediff('day', DATE '1970-01-01', p.report_date) % {SPLIT_K} = 0
         THEN 'test' ELSE 'train' END AS split,
    CAST(datediff('day', DATE '1970-01-01', p.report_date) AS DOUBLE) AS trend_days,
    sin(CAST(6.28318 AS DOUBLE) * CAST(dayofweek(p.report_date) + 1 AS INTEGER) / 7)
      AS weekday_sin,
    sin(CAST(6.28318 AS DOUBLE) * CAST(month(p.report_date) AS INTEGER) / 12) AS month_sin,
    CASE WHEN dayofweek(p.report_date) IN (0, 6) THEN 1.0::DOUBLE ELSE 0.0 END AS is_weekend,
    CASE WHEN p.report_date IN ({days}) THEN 1.0::DOUBLE ELSE 0.0 END AS is_holiday,
    {", ".join(lag_cols)}
  FROM mp p
  WINDOW d AS (PARTITION BY p.c_nationkey ORDER BY p.report_date))
SELECT * FROM ff WHERE {complete}
"""


FEATURES_SQL = _features_sql()


def certified(spark, data, spec, configs):
    """Certificates (config, target, train and test rows, does the fit hold, do its metrics)
    of the models of every configuration, all from one set of statistics."""
    n = len(spec.feature_names())
    stats = moments.moments(data, "features", n, spec.targets, by="split")
    rows = []
    for name, params in configs.items():
        reg = params.get("regParam", 0.0)
        coefs = moments.fit(stats["train"], n, spec.targets, reg)
        rows += [(name, *r) for r in certificates.certify_fit(
            data, "features", coefs, reg_param=reg,
            reported=moments.metrics(stats["test"], coefs, n))]
    return spark.createDataFrame(
        rows, "config string, target string, n_train bigint, n_test bigint, "
              "fit_holds boolean, metrics_hold boolean")


def one_pass_fit(data, spec, reg_param=0.0):
    """Coefficients of all targets from one scan of the train rows' features."""
    n = len(spec.feature_names())
    stats = moments.moments(data, "features", n, spec.targets, by="split")
    return moments.fit(stats["train"], n, spec.targets, reg_param)


# Rows and days are counted by SQL; what SQL cannot solve is certified in Spark.
CERTIFIED_SQL = f"""
SELECT config, target, n_train, n_test, TRUE AS fit_holds, TRUE AS metrics_hold
FROM (SELECT COUNT(*) FILTER (split = 'train') AS n_train,
             COUNT(*) FILTER (split = 'test') AS n_test FROM ({FEATURES_SQL}) f) n,
     (SELECT unnest(['wide', 'slim']) AS config) c,
     (SELECT unnest({list(SPEC.targets)}) AS target) t
"""


@register("ols_multi", CERTIFIED_SQL)
def ols_multi(spark, sf_dir):
    """Pooled linear models of 4 targets x 61 features (wide: no penalty; slim: ridge), fitted
    from one pass; per model the rows and whether normal equations and test metrics hold."""
    return certified(spark, packed_features(model_panel(spark, sf_dir), SPEC, KEYS), SPEC, CONFIGS)


@register("model_coefficients")
def model_coefficients(spark, sf_dir):
    """(target, term, value) of the slim models: intercept + 61 coefficients each."""
    _, models = fit_config(spark, sf_dir, "slim")
    return model.coefficients_frame(spark, models, SPEC)


@register("assemble_features", "SELECT c_nationkey, report_date, split, "
          + ", ".join(f"ROUND({n}, 6) AS {n}" for n in SPEC.feature_names())
          + f" FROM ({FEATURES_SQL}) f")
def assemble_features(spark, sf_dir):
    """The assembled 61-feature vectors, one column per entry (rounded to 1e-6)."""
    data = assembled_features(spark, sf_dir)
    v = vector_to_array("features")
    return data.select(*KEYS, "report_date", "split", *[
        F.round(F.get(v, F.lit(k)), 6).alias(n) for k, n in enumerate(SPEC.feature_names())])


@register("model_roundtrip", f"""
SELECT t.target, COUNT(*) AS n_scored, COUNT(*) AS n_equal
FROM ({FEATURES_SQL}) f, (SELECT unnest({list(SPEC.targets)}) AS target) t
WHERE f.split = 'test' GROUP BY t.target
""")
def model_roundtrip(spark, sf_dir):
    """Save one model per target, load the set back (fail fast if one is missing): test
    rows scored per target, and on how many the saved and the fitted model agree."""
    data, models = fit_config(spark, sf_dir, "slim")
    root = save_models(models, scratch_path(spark, "models"))
    loaded = load_models(root, SPEC.targets)
    test = data.filter(F.col("split") == "test")
    fitted, again = (model.score_models(m, test, KEYS, "report_date") for m in (models, loaded))
    both = fitted.join(again.withColumnRenamed("prediction", "loaded").drop("label"),
                       [*KEYS, "report_date", "target"])
    return both.groupBy("target").agg(
        F.count("prediction").alias("n_scored"),
        F.count_if(F.col("prediction") == F.col("loaded")).alias("n_equal"))


def certified_rollout(history, keys, spec, coefs, engine):
    """The rollout's certificate; its forecasts are written once."""
    fc = materialize(rollout.rollout_linear(history, keys, "report_date", spec, coefs, HORIZON,
                                            engine=engine), "forecasts")
    return certificates.certify_forecast(history, fc, keys, "report_date", spec, coefs)


@register("rollout_var", f"""
SELECT target, n_series, n_series * {HORIZON} AS n_rows,
       CAST(last + 1 AS DATE) AS first_day, CAST(last + {HORIZON} AS DATE) AS last_day,
       n_series * {HORIZON} AS n_hold
FROM (SELECT COUNT(DISTINCT c_nationkey) AS n_series, MAX(report_date) AS last
      FROM ({NATION_DAILY_SQL}) nd) s, (SELECT unnest({list(SPEC.targets)}) AS target) t
""")
def rollout_var(spark, sf_dir):
    """30-day forecast of all four targets per nation with the multi-feature models: per
    target the forecast rows and on how many the model's equation holds."""
    p = materialize(model_panel(spark, sf_dir), "model-panel")   # read by the fit and the rollout
    coefs = one_pass_fit(packed_features(p, SPEC, KEYS), SPEC, model.SLIM_PARAMS["regParam"])
    return certified_rollout(p, KEYS, SPEC, coefs, "sql")


@register("forecast_job")
def forecast_job_q(spark, sf_dir):
    """The whole workflow: train + save, load + 30-day forecast, filled feature
    matrix written as CSV (overwrite), submission written headerless and read back."""
    p = materialize(model_panel(spark, sf_dir), "model-panel")
    return _job(spark, p, SPEC, model.SLIM_PARAMS, "forecast-job")


def _job(spark, p, spec, params, name):
    root = scratch_path(spark, name)
    jobs.train_job(p, KEYS, "report_date", spec, params, f"{root}/models", SPLIT_K)
    fc, matrix = jobs.forecast_job(p, KEYS, "report_date", spec, f"{root}/models", HORIZON)
    write_csv(matrix, f"{root}/filled", mode="overwrite")
    sub = jobs.submission(fc, KEYS, "report_date", {t: t for t in TARGETS})
    write_csv(sub, f"{root}/submission", header=False)
    return read_csv(spark, f"{root}/submission",
                    "c_nationkey int, report_date string, purchase bigint, redeem bigint",
                    header=False)


def certified_job(spark, p, keys, spec, params, name):
    """The whole job, then what it published read back and certified, per target: forecasts by
    the saved models, lag cells of the horizon in the written matrix, submitted numbers."""
    root = scratch_path(spark, name)
    jobs.train_job(p, keys, "report_date", spec, params, f"{root}/models", SPLIT_K)
    fc, matrix = jobs.forecast_job(p, keys, "report_date", spec, f"{root}/models", HORIZON)
    fields = ", ".join([*[f"{k} int" for k in keys], "report_date date"])
    cells = [*spec.targets, *[f"{m}_{i}" for m in spec.targets for i in spec.lags]]
    write_csv(matrix.select(*keys, "report_date", *cells), f"{root}/filled", mode="overwrite")
    filled = read_csv(spark, f"{root}/filled",
                      ", ".join([fields, *[f"{c} double" for c in cells]]))
    columns = {t: t for t in spec.targets}
    write_csv(jobs.submission(fc, keys, "report_date", columns), f"{root}/submission", header=False)
    sent = read_csv(spark, f"{root}/submission", ", ".join(
        [fields.replace("report_date date", "report_date string"),
         *[f"{t} bigint" for t in columns]]), header=False)
    coefs = rollout.model_coefficients(load_models(f"{root}/models", spec.targets))
    first = fc.groupBy(*keys).agg(F.min("report_date").alias("first"))
    return (certificates.certify_forecast(p, fc, keys, "report_date", spec, coefs)
            .join(certificates.certify_lags(filled, keys, "report_date", spec.targets, spec.lags,
                                            first), "target")
            .join(certificates.certify_submission(sent, fc, keys, "report_date", columns),
                  "target"))


def certified_job_sql(targets, lags, series_sql: str) -> str:
    """Rows and days as SQL counts them; ``series_sql``: number of series and last day."""
    n = f"CAST(n_series * {HORIZON} AS BIGINT)"
    return f"""
SELECT target, CAST(n_series AS BIGINT) AS n_series, {n} AS n_rows,
       CAST(last + 1 AS DATE) AS first_day, CAST(last + {HORIZON} AS DATE) AS last_day,
       {n} AS n_hold, {n} * {len(lags)} AS n_cells, {n} * {len(lags)} AS n_cells_hold,
       {n} AS n_submitted, {n} AS n_submitted_hold
FROM ({series_sql}) s, (SELECT unnest({list(targets)}) AS target) t
"""


@register("forecast_job_certified", certified_job_sql(SPEC.targets, SPEC.lags, f"""
SELECT COUNT(DISTINCT c_nationkey) AS n_series, MAX(report_date) AS last
FROM ({NATION_DAILY_SQL}) nd"""))
def forecast_job_certified(spark, sf_dir):
    """Train, save, load, 30-day forecast, filled matrix and submission of 4 targets x 61
    features per nation: what was published, read back and certified per target."""
    p = materialize(model_panel(spark, sf_dir), "model-panel")
    return certified_job(spark, p, KEYS, SPEC, model.SLIM_PARAMS, "job-certified")


# --- the small job: fit, coefficients, metrics, rollout and submission with an oracle ---
SMALL_TRAIN_SQL = f"""
SELECT a.c_nationkey, a.report_date, CAST(a.purchase AS DOUBLE) AS purchase,
       CAST(a.redeem AS DOUBLE) AS redeem, CAST(b.purchase AS DOUBLE) AS x1,
       CAST(b.redeem AS DOUBLE) AS x2,
       datediff('day', DATE '1970-01-01', a.report_date) % {SPLIT_K} = 0 AS test
FROM ({NATION_PANEL_SQL}) a JOIN ({NATION_PANEL_SQL}) b
  ON a.c_nationkey = b.c_nationkey AND b.report_date = a.report_date - 1
"""
SMALL_FIT_SQL = f"""
WITH t AS (
  SELECT 'purchase' AS target, purchase AS y, x1, x2 FROM ({SMALL_TRAIN_SQL}) a WHERE NOT test
  UNION ALL
  SELECT 'redeem', redeem, x1, x2 FROM ({SMALL_TRAIN_SQL}) b WHERE NOT test),
m AS (
  SELECT target, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS s11,
    var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(y, x1) AS s1, covar_pop(y, x2) AS s2
  FROM t GROUP BY target),
b AS (
  SELECT *, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) AS b1,
    (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m)
SELECT target, b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b
"""
SMALL_ROLL_SQL = f"""
WITH RECURSIVE
np AS ({NATION_PANEL_SQL}),
f AS ({SMALL_FIT_SQL}),
k AS (SELECT p.b0 AS p0, p.b1 AS p1, p.b2 AS p2, q.b0 AS r0, q.b1 AS r1, q.b2 AS r2
      FROM f p, f q WHERE p.target = 'purchase' AND q.target = 'redeem'),
r(c_nationkey, step, report_date, purchase, redeem) AS (
  SELECT c_nationkey, 0, report_date, CAST(purchase AS DOUBLE), CAST(redeem AS DOUBLE) FROM np
  WHERE report_date = (SELECT MAX(report_date) FROM np)
  UNION ALL
  SELECT r.c_nationkey, r.step + 1, r.report_date + 1,
    k.p0 + k.p1 * r.purchase + k.p2 * r.redeem, k.r0 + k.r1 * r.purchase + k.r2 * r.redeem
  FROM r, k WHERE r.step < {HORIZON})
SELECT c_nationkey, CAST(report_date AS DATE) AS report_date, purchase, redeem
FROM r WHERE step > 0
"""


def _small_fit(spark, sf_dir):
    data = assembled_features(spark, sf_dir, nation_panel(spark, sf_dir), SMALL_SPEC)
    models = model.fit_targets(data.filter(F.col("split") == "train"), SMALL_SPEC,
                               model.WIDE_PARAMS)
    return data, models


@register("ols_small", f"""
SELECT target, 'intercept' AS term, ROUND(b0, 3) AS value FROM ({SMALL_FIT_SQL}) a
UNION ALL SELECT target, 'purchase_1', ROUND(b1, 8) FROM ({SMALL_FIT_SQL}) b
UNION ALL SELECT target, 'redeem_1', ROUND(b2, 8) FROM ({SMALL_FIT_SQL}) c
""")
def ols_small(spark, sf_dir):
    """Coefficients of the unpenalised two-feature models (pooled over nations)."""
    _, models = _small_fit(spark, sf_dir)
    out = model.coefficients_frame(spark, models, SMALL_SPEC)
    return out.withColumn("value", F.when(F.col("term") == "intercept", F.round("value", 3))
                          .otherwise(F.round("value", 8)))


@register("score_small", f"""
WITH s AS (
  SELECT f.target, CASE f.target WHEN 'purchase' THEN t.purchase ELSE t.redeem END AS y,
         f.b0 + f.b1 * t.x1 + f.b2 * t.x2 AS p
  FROM ({SMALL_TRAIN_SQL}) t, ({SMALL_FIT_SQL}) f WHERE t.test)
SELECT target, COUNT(*) AS n, ROUND(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
       ROUND(1 - sum((y - p) * (y - p)) / (var_pop(y) * COUNT(*)), 8) AS r2
FROM s GROUP BY target
""")
def score_small(spark, sf_dir):
    """Test metrics of the two-feature models after a save and load round trip."""
    data, models = _small_fit(spark, sf_dir)
    root = save_models(models, scratch_path(spark, "small-models"))
    pred = model.score_models(load_models(root, SMALL_SPEC.targets),
                              data.filter(F.col("split") == "test"), KEYS, "report_date")
    m = model.regression_metrics(pred, ["target"])
    return m.select("target", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 8).alias("r2"))


@register("forecast_small", f"""
SELECT c_nationkey, strftime(report_date, '%Y%m%d') AS report_date,
       CAST(TRUNC(purchase) AS BIGINT) AS purchase, CAST(TRUNC(redeem) AS BIGINT) AS redeem
FROM ({SMALL_ROLL_SQL}) r
""")
def forecast_small(spark, sf_dir):
    """The whole job on the two-feature spec: train + save, load + 30-day forecast, matrix
    as CSV, submission written headerless and read back."""
    p = materialize(nation_panel(spark, sf_dir), "small-panel")
    return _job(spark, p, SMALL_SPEC, model.WIDE_PARAMS, "forecast-small")


def _fixed_sql() -> str:
    state = [f"{t[0]}{i}" for t in TARGETS for i in range(1, 8)]
    last = "(SELECT MAX(report_date) FROM np)"
    start = ", ".join(f"MAX(CASE WHEN report_date = {last} - {i - 1} "
                      f"THEN CAST({t} AS DOUBLE) END) AS {t[0]}{i}"
                      for t in TARGETS for i in range(1, 8))
    step = {}
    for t in TARGETS:
        b, w = FIXED_COEFS[t]
        terms = [f"({b})", f"({w[0]}) * (CASE WHEN dayofweek(r.report_date + 1) IN (0, 6) "
                           f"THEN 1 ELSE 0 END)"]
        terms += [f"({w[1 + 3 * j + k]}) * r.{m[0]}{i}" for j, m in enumerate(TARGETS)
                  for k, i in enumerate(FIXED_SPEC.lags)]
        step[t] = " + ".join(terms)
    shifted = ", ".join([step["purchase"], *[f"r.p{i}" for i in range(1, 7)],
                         step["redeem"], *[f"r.r{i}" for i in range(1, 7)]])
    return f"""
WITH RECURSIVE np AS ({NATION_PANEL_SQL}),
r(c_nationkey, step, report_date, {", ".join(state)}) AS (
  SELECT c_nationkey, 0, {last}, {start} FROM np GROUP BY c_nationkey
  UNION ALL
  SELECT r.c_nationkey, r.step + 1, r.report_date + 1, {shifted} FROM r WHERE r.step < {HORIZON})
SELECT c_nationkey, CAST(report_date AS DATE) AS report_date, CAST(step AS INTEGER) AS step,
       ROUND(p1, 4) AS purchase, ROUND(r1, 4) AS redeem
FROM r WHERE step > 0
"""


@register("rollout_fixed", _fixed_sql())
def rollout_fixed(spark, sf_dir):
    """30-day rollout of both flows per nation under documented coefficients, lags 1, 2, 7."""
    r = rollout.rollout_linear(materialize(nation_panel(spark, sf_dir), "nation-panel"), KEYS,
                               "report_date", FIXED_SPEC, FIXED_COEFS, HORIZON)
    return r.select(*KEYS, "report_date", "step", *[F.round(t, 4).alias(t) for t in TARGETS])


# --- the wide pipeline: 26 targets x 371 features of one global series ---------------
def wide_panel(spark, sf_dir):
    """26 daily measures of the whole business, one row per day of the orders' range."""
    o = table(spark, sf_dir, "orders")
    o = o.select(to_day("o_orderdate").alias("report_date"), "o_orderstatus", "o_orderpriority",
                 cents(o, "o_totalprice").alias("price"))
    total = lambda cond: cents_sum(F.when(cond, F.col("price")).otherwise(0))
    orders = o.groupBy("report_date").agg(
        total(F.col("o_orderstatus").isin("O", "P")).alias("purchase"),
        total(F.col("o_orderstatus") == "F").alias("redeem"),
        F.count(F.lit(1)).alias("n_orders"),
        *[total(F.col("o_orderpriority").startswith(f"{k}-")).alias(f"priority_{k}")
          for k in (1, 2, 3, 4)])
    li = table(spark, sf_dir, "lineitem")
    value = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount",
             "tax": "l_tax"}
    part = {f: F.col("l_returnflag") == f.upper() for f in "anr"} | {"f": F.col("l_linestatus") == "F"}
    # each line is read and added once, to its day and flags; a day's 16 measures and the
    # averages of its business-day series are then sums of a few rows
    flags = li.select(to_day("l_shipdate").alias("report_date"), "l_returnflag", "l_linestatus",
                      *[cents(li, c).alias(c) for c in value.values()]) \
        .groupBy("report_date", "l_returnflag", "l_linestatus") \
        .agg(*[cents_sum(c).alias(m) for m, c in value.items()],
             *[F.count(c).alias(f"n_{m}") for m, c in value.items()])
    measure = {c: m for m, c in value.items()}
    average = lambda m: F.when(
        ~F.dayofweek("report_date").isin(1, 7) & (F.sum(f"n_{m}") > 0),
        F.sum(m).cast("double") / F.sum(f"n_{m}"))
    lines = flags.groupBy("report_date").agg(*[
        F.sum(F.when(cond, F.col(m)).otherwise(0)).cast(MONEY_SUM).alias(f"{m}_{f}")
        for f, cond in part.items() for m in value],
        *[average(measure[c]).alias(out) for out, c in WIDE_EXOG.items()])
    orders = materialize(orders, "wide-orders")
    days = panel.dense_panel(orders, [], "report_date", panel.day_range(orders, "report_date"),
                             {c: 0 for c in WIDE_ORDERS})
    days = panel.join_daily_series(days, [lines], "report_date")
    days = days.withColumns({c: F.coalesce(c, F.lit(0)) for c in WIDE_LINES})
    return materialize(panel.forward_fill(days, [], "report_date", list(WIDE_EXOG)), "wide-panel")


def wide_features(spark, sf_dir, panel_df=None):
    panel_df = panel_df if panel_df is not None else wide_panel(spark, sf_dir)
    return packed_features(panel_df, WIDE_SPEC, [])


# The first day with a business-day series starts the features; 14 days later they are whole.
WIDE_DAYS_SQL = f"""
SELECT CAST(d AS DATE) AS report_date FROM (
  SELECT unnest(generate_series(first + INTERVAL 14 DAY, CAST(last AS TIMESTAMP),
                                INTERVAL 1 DAY)) AS d
  FROM (SELECT MIN(CAST(l_shipdate AS DATE)) AS first, ANY_VALUE(b) AS last
        FROM lineitem, (SELECT MIN(CAST(o_orderdate AS DATE)) AS a,
                               MAX(CAST(o_orderdate AS DATE)) AS b FROM orders) o
        WHERE CAST(l_shipdate AS DATE) >= a AND dayofweek(l_shipdate) NOT IN (0, 6)) r) s
"""


@register("ols_wide", f"""
SELECT 'wide' AS config, target,
  COUNT(*) FILTER (datediff('day', DATE '1970-01-01', report_date) % {SPLIT_K} <> 0) AS n_train,
  COUNT(*) FILTER (datediff('day', DATE '1970-01-01', report_date) % {SPLIT_K} = 0) AS n_test,
  TRUE AS fit_holds, TRUE AS metrics_hold
FROM ({WIDE_DAYS_SQL}) d, (SELECT unnest({list(WIDE_TARGETS)}) AS target) t GROUP BY target
""")
def ols_wide(spark, sf_dir):
    """26 unpenalised models of 371 features from one pass over them: per model the rows and
    whether normal equations and test metrics hold."""
    return certified(spark, wide_features(spark, sf_dir), WIDE_SPEC, {"wide": model.WIDE_PARAMS})


@register("rollout_wide", f"""
SELECT target, CAST(1 AS BIGINT) AS n_series, CAST({HORIZON} AS BIGINT) AS n_rows,
       CAST(last + 1 AS DATE) AS first_day, CAST(last + {HORIZON} AS DATE) AS last_day,
       CAST({HORIZON} AS BIGINT) AS n_hold
FROM (SELECT MAX(CAST(o_orderdate AS DATE)) AS last FROM orders) o,
     (SELECT unnest({list(WIDE_TARGETS)}) AS target) t
""")
def rollout_wide(spark, sf_dir):
    """30-day forecast of all 26 targets of the one global series (companion form): per
    target the forecast rows and on how many the model's equation holds."""
    p = wide_panel(spark, sf_dir)
    coefs = one_pass_fit(wide_features(spark, sf_dir, p), WIDE_SPEC)
    return certified_rollout(p, [], WIDE_SPEC, coefs, "companion")


@register("forecast_job_wide", certified_job_sql(WIDE_TARGETS, WIDE_SPEC.lags, """
SELECT 1 AS n_series, MAX(CAST(o_orderdate AS DATE)) AS last FROM orders"""))
def forecast_job_wide(spark, sf_dir):
    """The whole job at 26 targets x 371 features of the one global series, certified."""
    return certified_job(spark, wide_panel(spark, sf_dir), [], WIDE_SPEC, model.WIDE_PARAMS,
                         "job-wide")
