"""Linear models on Spark: feature frames, fits, coefficients, scoring, metrics
and deterministic train / test splits.

* ``FeatureSpec`` is the one description of the feature vector shared by
  training and forecasting (trend + calendar + exact-date lags).
* Fits use ``pyspark.ml.regression.LinearRegression`` (a distributed
  aggregation of the normal equations / gradient per pass); the feature frame
  is checkpointed once before the per-target loop so each fit reads a
  materialised table instead of re-running the whole lineage.
* Per-series one-lag OLS (``ols_lag1``) and all metrics are plain grouped
  SQL aggregates: one shuffle, partial aggregation, any number of series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayflow.functions.calendar import (
    PI_APPROX, WEEKEND_SUN_SAT, calendar_columns, trend_columns,
)
from dayflow.operators.lags import DEFAULT_LAGS, lag_features, lag_name

CALENDAR_TERMS = ("weekday_sin", "weekday_cos", "month_sin", "month_cos", "is_weekend",
                  "is_holiday")

# The reference's two fitting configurations.
WIDE_PARAMS = {"maxIter": 50}                                  # no penalty
SLIM_PARAMS = {"maxIter": 80, "regParam": 0.1, "tol": 1e-5}    # ridge


@dataclass(frozen=True)
class FeatureSpec:
    """Targets and the feature vector: trend, calendar terms, lags of measures."""
    targets: tuple[str, ...]
    lag_measures: tuple[str, ...]
    lags: tuple[int, ...] = DEFAULT_LAGS
    calendar: tuple[str, ...] = CALENDAR_TERMS
    trend: str | None = "trend_days"
    weekend_days: tuple[int, ...] = WEEKEND_SUN_SAT
    holidays: tuple[str, ...] = field(default=())
    workday_overrides: tuple[str, ...] = field(default=())
    pi: float = PI_APPROX

    def lag_columns(self) -> list[str]:
        return [lag_name(m, i) for m in self.lag_measures for i in self.lags]

    def feature_names(self) -> list[str]:
        head = [self.trend] if self.trend else []
        return head + list(self.calendar) + self.lag_columns()

    def date_terms(self, date_col: str | Column) -> dict[str, Column]:
        """Trend + calendar feature expressions of a date column (as doubles)."""
        cal = calendar_columns(date_col, self.pi, self.weekend_days, self.workday_overrides,
                               self.holidays)
        out = {}
        if self.trend:
            trends = trend_columns(date_col, session_timestamp=True)
            if self.trend not in trends:
                raise ValueError(f"unknown trend {self.trend!r}: one of {sorted(trends)}")
            out[self.trend] = trends[self.trend].cast("double")
        out.update({c: cal[c].cast("double") for c in self.calendar})
        return out


def feature_frame(panel: DataFrame, keys: Sequence[str], date_col: str,
                  spec: FeatureSpec) -> DataFrame:
    """Panel + date terms + exact-date lags; measures and targets as doubles."""
    measures = sorted(set(spec.targets) | set(spec.lag_measures))
    missing = [c for c in [*keys, date_col, *measures] if c not in panel.columns]
    if missing:
        raise ValueError(f"feature_frame: unknown columns {missing}")
    typed = panel.select(*keys, date_col, *[F.col(m).cast("double").alias(m) for m in measures])
    lagged = lag_features(typed, keys, date_col, spec.lag_measures, spec.lags)
    return lagged.withColumns(spec.date_terms(date_col))


def feature_arrays(panel: DataFrame, keys: Sequence[str], date_col: str,
                   spec: FeatureSpec) -> DataFrame:
    """Complete rows as keys, date, targets (doubles) and ``features``, one array.

    The values and order of :func:`feature_frame` and :func:`assemble`, built from one
    array of measures a lag instead of a column a feature: the plan does not grow with the
    number of measures.
    """
    measures = sorted(set(spec.targets) | set(spec.lag_measures))
    missing = [c for c in [*keys, date_col, *measures] if c not in panel.columns]
    if missing:
        raise ValueError(f"feature_arrays: unknown columns {missing}")
    value = {m: F.col(m).cast("double") for m in measures}
    typed = panel.select(*keys, date_col, *[value[t].alias(t) for t in spec.targets],
                         pack(spec, value).alias(PACKED))
    lagged = lag_features(typed, keys, date_col, [PACKED], spec.lags)
    out = lagged.select(*keys, date_col, *spec.targets,
                        packed_features(spec, date_col).alias("features"))
    return out.filter(~F.exists("features", lambda v: v.isNull() | F.isnan(v)))


PACKED = "__measures"


def pack(spec: FeatureSpec, value: Mapping[str, Column]) -> Column:
    """The lag measures as one array."""
    return F.array(*[value[m] for m in spec.lag_measures]).cast("array<double>")


def packed_features(spec: FeatureSpec, date_col: str) -> Column:
    """The feature array from the date and the lags of the packed measures."""
    terms = spec.date_terms(date_col)
    head = F.array(*[terms[n] for n in spec.feature_names()[:len(terms)]]).cast("array<double>")
    if not spec.lag_measures:
        return head
    return F.concat(head, F.flatten(F.transform(
        F.sequence(F.lit(0), F.lit(len(spec.lag_measures) - 1)),
        lambda k: F.array(*[F.get(F.col(lag_name(PACKED, i)), k) for i in spec.lags]))))


def complete_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rows where every feature is present (the first max(lag) days of a series drop)."""
    conds = [F.col(c).isNotNull() for c in spec.feature_names()] or [F.lit(True)]
    while len(conds) > 1:      # a balanced tree: a chain of 371 terms would nest too deeply
        conds = [a & b for a, b in zip(conds[::2], conds[1::2])] + conds[len(conds) // 2 * 2:]
    return df.filter(conds[0])


def assemble(df: DataFrame, spec: FeatureSpec, out: str = "features",
             handle_invalid: str = "skip") -> DataFrame:
    """``VectorAssembler`` over the spec's features (explicit ``handleInvalid``)."""
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=spec.feature_names(), outputCol=out,
                         handleInvalid=handle_invalid)
    return va.transform(df)


def fit_targets(train: DataFrame, spec: FeatureSpec,
                params: Mapping[str, object] = SLIM_PARAMS,
                features_col: str = "features", parallelism: int | None = None) -> dict:
    """One ``LinearRegression`` per target over an assembled, materialised frame.

    The fits are independent, so they are submitted as concurrent Spark jobs
    (``parallelism`` threads, default one per target) - the pattern of
    ``CrossValidator(parallelism=...)``: per-job scheduling overhead overlaps
    and a cluster is kept busy even when one fit's data is small.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.regression import LinearRegression

    def fit(t):
        return t, LinearRegression(featuresCol=features_col, labelCol=t, **params).fit(train)

    n = parallelism or len(spec.targets)
    if n <= 1:
        return dict(fit(t) for t in spec.targets)
    with ThreadPoolExecutor(max_workers=n) as pool:
        return dict(pool.map(fit, spec.targets))


def coefficients_frame(spark: SparkSession, models: Mapping[str, object],
                       spec: FeatureSpec) -> DataFrame:
    """(target, term, value): intercept and one row per feature coefficient."""
    rows = []
    names = spec.feature_names()
    for t, m in models.items():
        rows.append((t, "intercept", float(m.intercept)))
        rows += [(t, n, float(v)) for n, v in zip(names, m.coefficients.toArray())]
    return spark.createDataFrame(rows, "target string, term string, value double")


def score_models(models: Mapping[str, object], df: DataFrame, keys: Sequence[str],
                 date_col: str, features_col: str = "features") -> DataFrame:
    """Long predictions (keys, date, target, label, prediction) of every model.

    The models are chained over one frame, a prediction column each, and the
    columns are turned into rows once: one scan of ``df`` for any number of models.
    """
    wide = df.select(*keys, date_col, features_col, *models)
    for k, m in enumerate(models.values()):
        wide = m.copy({m.predictionCol: f"__p{k}"}).transform(wide)
    rows = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("label"),
                              F.col(f"__p{k}").alias("prediction"))
                     for k, t in enumerate(models)])
    return (wide.select(*keys, date_col, F.explode(rows).alias("__r"))
            .select(*keys, date_col, "__r.target", "__r.label", "__r.prediction"))


def regression_metrics(pred: DataFrame, group_cols: Sequence[str], label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """Per group: n, RMSE and R2 (= 1 - SSres / SStot) as one grouped aggregate."""
    err = (F.col(label) - F.col(prediction))
    sq = err * err
    n = F.count(err)
    ss_tot = F.var_pop(F.when(err.isNotNull(), F.col(label))) * n
    return pred.groupBy(*group_cols).agg(
        n.alias("n"),
        F.sqrt(F.avg(sq)).alias("rmse"),
        F.when(ss_tot > 0, 1 - F.sum(sq) / ss_tot).alias("r2"))


def ols_lag1(long_df: DataFrame, group_cols: Sequence[str], y: str = "y",
             x: str = "x", last_day: str | None = None) -> DataFrame:
    """Per group simple OLS of y on x (``regr_slope`` / ``regr_intercept``).

    With ``last_day`` the same aggregate also returns the series' last day
    (under that name) and its ``y`` as ``y0``: the start state of a rollout.
    """
    extra = []
    if last_day:
        extra = [F.max(last_day).alias(last_day), F.max_by(y, last_day).alias("y0")]
    return long_df.groupBy(*group_cols).agg(
        F.count(F.when(F.col(y).isNotNull(), F.col(x))).alias("n_obs"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"), *extra)


def score_lag1(long_df: DataFrame, group_cols: Sequence[str], y: str = "y",
               x: str = "x", out: str = "prediction") -> DataFrame:
    """In-sample ``intercept + slope * x`` with the per-group fit as a window aggregate."""
    w = Window.partitionBy(*group_cols)
    return long_df.withColumns({
        "slope": F.regr_slope(y, x).over(w),
        "intercept": F.regr_intercept(y, x).over(w),
    }).withColumn(out, F.col("intercept") + F.col("slope") * F.col(x))


def split_mod(df: DataFrame, date_col: str, k: int = 5, test_bucket: int = 0,
              out: str = "split") -> DataFrame:
    """Deterministic split: a day is 'test' when ``unix_date(day) mod k == test_bucket``.

    Independent of partitioning and row order (unlike a seeded ``randomSplit``),
    and all series share the same test days.
    """
    b = F.pmod(F.unix_date(F.col(date_col).cast("date")), F.lit(k))
    return df.withColumn(out, F.when(b == test_bucket, F.lit("test")).otherwise(F.lit("train")))


def split_random(df: DataFrame, test_fraction: float = 0.2, seed: int = 1234,
                 out: str = "split") -> DataFrame:
    """Compatibility with a seeded 80/20 ``randomSplit``: each row is 'test' with
    probability ``test_fraction``.  Like ``randomSplit`` it depends on the
    partitioning and ignores time order (it leaks the future into training);
    prefer :func:`split_mod` or :func:`split_time`."""
    return df.withColumn(out, F.when(F.rand(seed) < test_fraction, F.lit("test"))
                         .otherwise(F.lit("train")))


def split_time(df: DataFrame, date_col: str, test_days: int, out: str = "split") -> DataFrame:
    """Time holdout: the last ``test_days`` days (after the global last day - n) are 'test'."""
    day = F.col(date_col).cast("date")
    cutoff = F.date_sub(df.select(F.max(day)).scalar(), test_days)
    return df.withColumn(out, F.when(day > cutoff, F.lit("test"))
                         .otherwise(F.lit("train")))
