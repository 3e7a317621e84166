"""Multi-step forecasts rolled forward for many series in parallel.

The reference predicts one day at a time on the driver (a ``collect`` per
target per day, then a column rewrite per future lag cell).  Here a forecast
is one distributed job and parallel across series:

* ``rollout_ar1``: per series y[h] = a + b * y[h-1].  The whole path is one
  SQL higher-order expression (``aggregate`` over ``sequence(1, H)``) on the
  series' row, then ``posexplode``: JVM-side, no Python, no shuffle.
* ``rollout_linear``: the general model (trend + calendar + exact-date lags of
  every target), where all targets of day t read only values of days < t.
  Default engine ``"sql"``: each series' last ``max(lags)`` days become a
  ``map<date, array<double>>`` (one bounded ``collect_list`` per series), and
  ``aggregate(sequence(1, H), map, step)`` adds one day per step: the date
  terms are the training expressions applied to the step's date, exact-date
  lags are map lookups (null when the day is absent), and every target is a
  dot product with literal coefficient arrays.  JVM-side, no Python.
  Engine ``"pandas"``: the same recursion in numpy, one bounded
  ``applyInPandas`` group per series (history tail + horizon rows); faster for
  very wide specs, and only used when asked for.
  Engine ``"companion"``: the recursion as a linear recurrence; all steps of all
  series of a batch are one matrix product (:mod:`dayflow.operators.companion`).
  All engines keep one contract: unique (keys, day) rows or an error, NaN
  measures count as null, coefficient counts are checked when the plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructField, StructType

from dayflow.operators.companion import companion_rollout
from dayflow.operators.model import FeatureSpec
from dayflow.operators.panel import require_columns


def rollout_ar1(start: DataFrame, keys: Sequence[str], date_col: str, horizon: int,
                y0: str = "y0", intercept: str = "intercept", slope: str = "slope",
                out: str = "forecast") -> DataFrame:
    """Roll y[h] = intercept + slope * y[h-1] forward ``horizon`` days per row.

    ``start`` has one row per series: keys, the last observed ``date_col``, the
    last value ``y0`` and the fitted coefficients.  Output: keys, ``step``
    (1..horizon), ``date_col`` (last day + step), ``out``.
    """
    a, b = F.col(intercept).cast("double"), F.col(slope).cast("double")
    path = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.array(F.col(y0).cast("double")),
        lambda acc, _i: F.concat(acc, F.array(a + b * F.element_at(acc, -1))))
    steps = start.select(*keys, F.col(date_col).alias("__last"),
                         F.posexplode(F.slice(path, 2, horizon)).alias("__pos", out))
    return steps.select(*keys, (F.col("__pos") + 1).alias("step"),
                        F.date_add("__last", F.col("__pos") + 1).alias(date_col), out)


def _linear_step_fn(keys: Sequence[str], date_col: str, spec: FeatureSpec,
                    coefs: Mapping[str, tuple[float, Sequence[float]]]):
    targets = list(spec.targets)
    tpos = {t: j for j, t in enumerate(targets)}
    date_terms = ([spec.trend] if spec.trend else []) + list(spec.calendar)
    lag_cols = np.array([tpos[m] for m in spec.lag_measures for _ in spec.lags], dtype=int)
    lag_days = np.array([i for _ in spec.lag_measures for i in spec.lags], dtype=int)
    icpt = np.array([coefs[t][0] for t in targets], dtype=float)
    weights = np.array([list(coefs[t][1]) for t in targets], dtype=float)  # (T, F)

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date_col)
        day = pd.to_datetime(pdf[date_col]).to_numpy().astype("datetime64[D]").astype(np.int64)
        base = day.min()
        fut = pdf["__future"].to_numpy(dtype=bool)
        # values by day offset (NaN = no row / null), history first, forecasts appended
        vals = np.full((day.max() - base + 1, len(targets)), np.nan)
        vals[day[~fut] - base] = pdf.loc[~fut, targets].to_numpy(dtype=float)
        terms = pdf.loc[fut, date_terms].to_numpy(dtype=float)
        out = np.full((int(fut.sum()), len(targets)), np.nan)
        for n, k in enumerate(day[fut] - base):
            src = k - lag_days
            lagv = np.full(len(lag_days), np.nan)
            ok = src >= 0
            lagv[ok] = vals[src[ok], lag_cols[ok]]
            x = np.concatenate([terms[n], lagv])
            if not np.isnan(x).any():      # a missing exact-date lag leaves the day null
                out[n] = icpt + weights @ x
            vals[k] = out[n]               # simultaneous update: after all targets
        res = pdf.loc[fut, [*keys, date_col]].reset_index(drop=True)
        res["step"] = np.arange(1, len(res) + 1, dtype=np.int32)
        for j, t in enumerate(targets):
            res[t] = pd.Series(out[:, j]).astype("Float64")      # NaN -> null
        return res

    return step


ENGINES = ("sql", "pandas", "companion")
DUPLICATE_DAYS = "rollout history has more than one row for a (key, day)"


def _history_tail(history: DataFrame, keys: Sequence[str], date_col: str,
                  spec: FeatureSpec) -> DataFrame:
    missing = [m for m in spec.lag_measures if m not in spec.targets]
    if missing:
        raise ValueError(f"lag measures {missing} are not forecast targets")
    depth = max(spec.lags)
    measures = sorted(set(spec.targets) | set(spec.lag_measures))
    require_columns(history, [*keys, date_col, *measures], "rollout history")
    value = {m: F.col(m).cast("double") for m in measures}
    rows = history.select(*keys, F.col(date_col).cast("date").alias(date_col),
                          *[F.when(~F.isnan(c), c).alias(m) for m, c in value.items()])
    # every row counts for uniqueness, also one before the tail: one aggregate per (key,
    # day), which the rank's window reuses the partitioning of
    if keys:
        rows = rows.repartition(*[F.col(k) for k in keys])
    n = F.count(F.lit(1))
    days = rows.groupBy(*keys, date_col).agg(n.alias("__n"), *[F.max(m).alias(m) for m in measures])
    checked = F.when(F.col("__n") > 1, F.raise_error(F.lit(DUPLICATE_DAYS)).cast("date")).otherwise(
        F.col(date_col))
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).desc())
    return (days.withColumn(date_col, checked).drop("__n")
            .withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") <= depth).drop("__rn"))


def rollout_linear(history: DataFrame, keys: Sequence[str], date_col: str,
                   spec: FeatureSpec, coefs: Mapping[str, tuple[float, Sequence[float]]],
                   horizon: int, engine: str = "sql") -> DataFrame:
    """Forecast every target ``horizon`` days past each series' last day.

    ``coefs[target] = (intercept, [coefficient per spec.feature_names()])``.
    Lag measures must be targets (their future values are the forecasts).  Two
    rows for one (keys, day) raise; a lag that falls on a missing day, a null
    or a NaN makes that forecast null (exact-date semantics).  ``keys=[]`` is
    one global series.  ``engine``: "sql", "pandas" or "companion", same results (the
    last up to rounding, as it multiplies in another order).
    Output: keys, ``date_col``, ``step`` (1..horizon), one double per target.
    """
    if engine not in ENGINES:
        raise ValueError(f"unknown engine {engine!r}")
    n_features = len(spec.feature_names())
    for t in spec.targets:
        if len(coefs[t][1]) != n_features:
            raise ValueError(f"{t}: {len(coefs[t][1])} coefficients for {n_features} features")
    tail = _history_tail(history, keys, date_col, spec)
    if engine == "companion":
        return companion_rollout(tail, keys, date_col, spec, coefs, horizon)
    if engine == "sql":
        return _rollout_linear_sql(tail, keys, date_col, spec, coefs, horizon)
    measures = sorted(set(spec.targets) | set(spec.lag_measures))
    ends = (tail.groupBy(*keys).agg(F.max(date_col).alias("__end"))
            .filter(F.col("__end").isNotNull()))
    future = ends.select(*keys, F.explode(F.sequence(F.date_add("__end", 1),
                                                     F.date_add("__end", horizon)))
                         .alias(date_col))
    terms = spec.date_terms(date_col)
    future = future.select(*keys, date_col, F.lit(True).alias("__future"),
                           *[F.lit(None).cast("double").alias(m) for m in measures],
                           *[e.alias(n) for n, e in terms.items()])
    past = tail.select(*keys, date_col, F.lit(False).alias("__future"), *measures,
                       *[F.lit(None).cast("double").alias(n) for n in terms])
    both = past.unionByName(future)
    schema = StructType([*[history.schema[k] for k in keys], StructField(date_col, DateType()),
                         StructField("step", IntegerType()),
                         *[StructField(t, DoubleType()) for t in spec.targets]])
    return both.groupBy(*keys).applyInPandas(
        _linear_step_fn(keys, date_col, spec, coefs), schema=schema)


def _rollout_linear_sql(tail: DataFrame, keys: Sequence[str], date_col: str,
                        spec: FeatureSpec, coefs: Mapping[str, tuple[float, Sequence[float]]],
                        horizon: int) -> DataFrame:
    targets = list(spec.targets)
    pos = {t: i + 1 for i, t in enumerate(targets)}           # 1-based array slots
    names = spec.feature_names()
    # literal coefficient matrix (targets x features) and intercepts; constant-folded
    weights = F.array(*[F.array(*[F.lit(float(w)) for w in coefs[t][1]]) for t in targets])
    icpts = F.array(*[F.lit(float(coefs[t][0])) for t in targets])
    state = tail.groupBy(*keys).agg(
        F.max(date_col).alias("__end"),
        F.map_from_entries(F.collect_list(F.struct(
            F.col(date_col), F.array(*[F.col(t) for t in targets])))).alias("__vals"))
    state = state.filter(F.col("__end").isNotNull())       # keys=[] over an empty history
    end = F.col("__end")

    def predict(xv):
        # every target from one feature vector: b_t + sum_j w_tj * x_j
        return F.zip_with(icpts, weights, lambda b, w: b + F.aggregate(
            F.zip_with(w, xv, lambda c, v: c * v), F.lit(0.0), lambda acc, v: acc + v))

    def step(vals, i):
        d = F.date_add(end, i)
        terms = spec.date_terms(d)
        lags = [F.try_element_at(F.try_element_at(vals, F.date_sub(d, lag)), F.lit(pos[m]))
                for m in spec.lag_measures for lag in spec.lags]
        x = F.array(*[terms[n] for n in names[:len(names) - len(lags)]], *lags)
        # bind the feature vector to a lambda variable so it is built once per
        # step, not once per target (no common-subexpression elimination in lambdas)
        preds = F.element_at(F.transform(F.array(x), predict), 1)
        return F.map_concat(vals, F.create_map(d, preds))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("__vals"), step)
    days = F.transform(F.sequence(F.lit(1), F.lit(horizon)),
                       lambda i: F.struct(i.alias("step"), F.date_add(end, i).alias("d")))
    # the recursion is evaluated once per series, in its own projection, before
    # the horizon rows are generated from it
    rolled = state.select(*keys, "__end", path.alias("__path"))
    out = rolled.select(*keys, "__path", F.explode(days).alias("__h"))
    return out.select(*keys, F.col("__h.d").alias(date_col), F.col("__h.step").alias("step"),
                      *[F.element_at(F.element_at("__path", F.col("__h.d")), pos[t]).alias(t)
                        for t in targets])


def model_coefficients(models: Mapping[str, object]) -> dict[str, tuple[float, list[float]]]:
    """``{target: (intercept, coefficients)}`` from fitted Spark ML linear models."""
    return {t: (float(m.intercept), [float(v) for v in m.coefficients.toArray()])
            for t, m in models.items()}
