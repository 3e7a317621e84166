"""Certificates: checks of fits and forecasts that need no second solver.

A least-squares fit is right if its residuals are orthogonal to the features (up to the
ridge term); a forecast is right if every step equals the model applied to the filled
feature matrix.  Both are one distributed pass over the rows, independent of how the
coefficients or the forecasts were found, so a result can be certified where no SQL or
second library could solve it.  The filled matrix and the submission of a job are checked as
written: lag cells against the matrix's own cells, submitted numbers against the forecasts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from dayflow.operators.lags import lag_features
from dayflow.operators.model import PACKED, FeatureSpec, pack, packed_features
from dayflow.operators.moments import Coefficients, as_array, matrix

TOLERANCE = 1e-7            # of a fit: correlation of residuals and features
STEP_TOLERANCE = 1e-9       # of a forecast: relative to the sum of its terms' sizes


def residual_sums(df: DataFrame, features_col: str, coefs: Coefficients,
                  by: str) -> dict[str, dict[str, np.ndarray]]:
    """Per value of ``by``: ``n`` and sums over rows of the residuals ``r``, targets ``y``,
    features ``x``, their squares and the products ``xr``; rows are scored in the pass."""
    targets = list(coefs)
    beta = np.array([coefs[t][1] for t in targets]).T
    intercepts = np.array([coefs[t][0] for t in targets])
    rows = df.select(F.col(by).cast("string").alias("grp"), as_array(df, features_col).alias("x"),
                     F.array(*[F.col(t).cast("double") for t in targets]).alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[str, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            xs, ys = matrix(batch.column(1), len(beta)), matrix(batch.column(2), len(targets))
            keys = np.array(batch.column(0).to_pylist(), dtype=object)
            for key in set(keys):
                x, y = xs[keys == key], ys[keys == key]
                r = y - (x @ beta + intercepts)
                new = {"n": np.array([float(len(x))]), "r": r.sum(0), "rr": (r * r).sum(0),
                       "y": y.sum(0), "yy": (y * y).sum(0), "x": x.sum(0), "xx": (x * x).sum(0),
                       "xr": (x.T @ r).ravel()}
                old = sums.get(key)
                sums[key] = {k: v + old[k] if old else v for k, v in new.items()}
        out = [(g, k, i, float(v)) for g, s in sums.items() for k, a in s.items()
               for i, v in enumerate(a)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[c] for o in out], t) for c, t in enumerate(
                (pa.string(), pa.string(), pa.int64(), pa.float64()))], ["grp", "name", "i", "v"])

    found = (rows.mapInArrow(run, "grp string, name string, i bigint, v double")
             .groupBy("grp", "name", "i").agg(F.sum("v").alias("v")).collect())
    size = {"n": 1, "x": len(beta), "xx": len(beta), "xr": len(beta) * len(targets)}
    out: dict[str, dict[str, np.ndarray]] = {}
    for g, name, i, v in found:
        sums = out.setdefault(g, {})
        sums.setdefault(name, np.zeros(size.get(name, len(targets))))[i] = v
    return out


def normal_equations(sums: Mapping[str, np.ndarray], coefs: Coefficients,
                     reg_param: float = 0.0) -> dict[str, float]:
    """Largest violation of the normal equations per target, as a correlation.

    For every feature: its correlation with the residuals less the ridge term; for the
    intercept: the mean residual over the target's standard deviation.  0 is a perfect fit
    of the model (not of the data).
    """
    n = sums["n"][0]
    targets = list(coefs)
    xr = sums["xr"].reshape(-1, len(targets))
    sd = lambda s, ss: np.sqrt(np.maximum(ss / n - (s / n) ** 2, 0))
    sx, sy = sd(sums["x"], sums["xx"]), sd(sums["y"], sums["yy"])
    out = {}
    for j, t in enumerate(targets):
        spread = sy[j] or 1.0
        cov = xr[:, j] / n - sums["x"] / n * (sums["r"][j] / n)
        live = sx > 1e-13 * np.abs(sums["x"] / n)
        ridge = reg_param / spread * np.array(coefs[t][1]) * sx / spread
        gap = cov[live] / (sx[live] * spread) - ridge[live]
        out[t] = float(max(np.abs(gap).max(initial=0), abs(sums["r"][j] / n) / spread))
    return out


def certify_fit(df: DataFrame, features_col: str, coefs: Coefficients, split_col: str = "split",
                reg_param: float = 0.0, reported: Mapping[str, tuple] | None = None,
                tolerance: float = TOLERANCE) -> list[tuple]:
    """``(target, train rows, test rows, fit holds, metrics hold)`` per target.

    ``fit holds``: the train rows satisfy the normal equations to ``tolerance``.
    ``metrics hold``: ``reported`` RMSE and R2 (``{target: (rows, rmse, r2)}``) are those of
    the scored test rows.
    """
    sums = residual_sums(df, features_col, coefs, split_col)
    if "train" not in sums:
        raise ValueError("certify_fit: no train rows")
    train, test = sums["train"], sums.get("test")
    gaps = normal_equations(train, coefs, reg_param)
    out = []
    for j, t in enumerate(coefs):
        ok = reported is None
        n_test = int(test["n"][0]) if test else 0
        if reported is not None and test:
            n, rmse, r2 = reported[t]
            total = test["yy"][j] - test["y"][j] ** 2 / n_test
            want = float(np.sqrt(test["rr"][j] / n_test))
            ok = n == n_test and abs(rmse - want) <= 1e-6 * max(want, 1e-300) and (
                r2 is None or abs(r2 - (1 - test["rr"][j] / total)) <= 1e-6)
        out.append((t, int(train["n"][0]), n_test, bool(gaps[t] <= tolerance), bool(ok)))
    return out


def certify_forecast(history: DataFrame, forecasts: DataFrame, keys: Sequence[str], date_col: str,
                     spec: FeatureSpec, coefs: Coefficients,
                     tolerance: float = STEP_TOLERANCE) -> DataFrame:
    """Per target: series, forecast rows, first and last day, and rows that hold.

    A row holds if it equals the model applied to the features of the filled matrix
    (history and forecasts, by the training operators), relative to the size of its terms.
    Rows without complete features must have no forecast.
    """
    targets = list(spec.targets)
    cells = [F.col(t).cast("double").alias(t) for t in targets]
    both = (history.select(*keys, F.col(date_col).cast("date").alias(date_col), *cells,
                           F.lit(False).alias("__ahead"))
            .unionByName(forecasts.select(*keys, date_col, *cells, F.lit(True).alias("__ahead"))))
    end = F.max(F.when(~F.col("__ahead"), F.col(date_col))).over(Window.partitionBy(*keys))
    near = both.withColumn("__end", end).filter(
        F.col("__ahead") | (F.col(date_col) > F.date_sub("__end", max(spec.lags)))).drop("__end")
    near = near.withColumn(PACKED, pack(spec, {m: F.col(m) for m in spec.lag_measures}))
    rows = lag_features(near, keys, date_col, [PACKED], spec.lags).filter("__ahead")
    beta = np.array([coefs[t][1] for t in targets], float).T
    intercepts = np.array([coefs[t][0] for t in targets], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(len(keys) + 1), len(beta), complete=False)
            y = matrix(batch.column(len(keys) + 2), len(targets), complete=False)
            whole = ~np.isnan(x).any(axis=1)
            x = np.nan_to_num(x)
            size = np.abs(x) @ np.abs(beta) + np.abs(intercepts)
            ok = np.where(whole[:, None], np.abs(y - (x @ beta + intercepts)) <= tolerance * size,
                          np.isnan(y))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys) + 1], pa.array(ok.tolist(), pa.list_(pa.bool_()))],
                [*keys, date_col, "__ok"])

    schema = StructType([*[rows.schema[c] for c in (*keys, date_col)],
                         StructField("__ok", ArrayType(BooleanType()))])
    held = (rows.select(*keys, date_col, packed_features(spec, date_col).alias("__x"), F.array(*targets).alias("__y"))
            .mapInArrow(run, schema))
    one = F.struct(*keys) if keys else F.lit(1)
    names = F.array(*map(F.lit, targets))
    return (held.select(one.alias("__key"), date_col, F.posexplode("__ok").alias("__at", "__ok"))
            .groupBy(F.get(names, F.col("__at")).alias("target")).agg(
                F.count_distinct("__key").alias("n_series"), F.count(F.lit(1)).alias("n_rows"),
                F.min(date_col).alias("first_day"), F.max(date_col).alias("last_day"),
                F.count_if("__ok").alias("n_hold")))


def certify_lags(matrix_df: DataFrame, keys: Sequence[str], date_col: str,
                 measures: Sequence[str], lags: Sequence[int],
                 first: DataFrame | None = None) -> DataFrame:
    """Per measure: ``n_cells`` lag cells and the ``n_cells_hold`` of them that hold.

    A cell ``{measure}_{lag}`` holds if it equals the measure's own cell of the key's row that
    many days before, and is null where there is no such row or its cell is null.  ``first``
    (keys and a ``first`` day, one row per key, or one row without keys) restricts the check
    to the rows from that day on.  Each cell is joined to its source on (key, measure, day),
    so neither a key nor a day is gathered, and windows have no part in it.
    """
    days = matrix_df.withColumn(date_col, F.col(date_col).cast("date"))
    if first is None:
        days = days.withColumn("__first", F.lit(None).cast("date"))
    elif keys:
        days = days.join(first.select(*keys, F.col("first").alias("__first")), list(keys))
    else:
        days = days.withColumn("__first", first.select("first").scalar())
    begin = F.coalesce(F.col("__first"), F.col(date_col))

    def long(df: DataFrame, cells: list, day) -> DataFrame:
        return (df.select(*keys, F.col(date_col).alias("__day"), F.explode(F.array(*cells)).alias("__c"))
                .select(*keys, F.col("__c.measure").alias("__measure"), day.alias("__day"),
                        F.col("__c.cell").alias("__cell")))

    cell = lambda m, name, i: F.struct(
        F.lit(m).alias("measure"), F.lit(i).alias("lag"), F.col(name).cast("double").alias("cell"))
    got = long(days.filter(F.col(date_col) >= begin),
               [cell(m, f"{m}_{i}", i) for m in measures for i in lags],
               F.date_sub(F.col("__day"), F.col("__c.lag")))
    source = long(days.filter(F.col(date_col) >= F.date_sub(begin, max(lags))),
                  [cell(m, m, 0) for m in measures], F.col("__day"))
    on = [*keys, "__measure", "__day"]
    both = got.join(source.withColumnRenamed("__cell", "__source"), on, "left")
    return both.groupBy(F.col("__measure").alias("target")).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(F.col("__cell").eqNullSafe(F.col("__source"))).alias("n_cells_hold"))


def certify_submission(submitted: DataFrame, forecasts: DataFrame, keys: Sequence[str],
                       date_col: str, columns: Mapping[str, str]) -> DataFrame:
    """Per target: ``n_submitted`` rows of the submission and the ``n_submitted_hold`` that are
    its forecast of that key and yyyyMMdd day, cut to a whole number.

    A row without a forecast, or the second one of a key and day, does not hold; a forecast
    without a row is missing from ``n_submitted``.
    """
    day = F.date_format(date_col, "yyyyMMdd")
    want = forecasts.select(*keys, day.alias(date_col), F.lit(True).alias("__found"), *[
        F.col(t).cast("bigint").alias(f"__{t}") for t in columns.values()])
    got = submitted.select(*keys, F.col(date_col).cast("string").alias(date_col), *columns)
    one = got.groupBy(*keys, date_col).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in columns])
    held = one.join(want, [*keys, date_col], "left").select("__n", F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), (F.col("__found").isNotNull()
                 & F.col(c).eqNullSafe(F.col(f"__{t}"))).alias("ok"))
        for c, t in columns.items()])).alias("__c"))
    return held.groupBy("__c.target").agg(F.sum("__n").alias("n_submitted"),
                                          F.count_if("__c.ok").alias("n_submitted_hold"))
