"""Linear models of many targets from one pass over the features.

All targets share the features, so one set of sufficient statistics (row count, means
and the centred cross products of features and targets) fits every one of them: one
scan of the feature frame, whatever the number of targets.  Statistics of any grouping
(train and test, say) come from the same scan, and the metrics of a fitted model on a
group follow from the group's statistics without scoring its rows.

A task keeps one set per group, ``(features + targets) ** 2`` numbers, and merges its
batches into it; sets of tasks are merged in a tree.  Products are taken of centred
batches, and merging corrects for the difference of means, so large means (trends, money)
cost no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

MERGED = 32           # sets that one task of the tree merges
Coefficients = dict[str, tuple[float, list[float]]]
_STATE = "grp string, n bigint, mean binary, scatter binary"
_NAMES = ["grp", "n", "mean", "scatter"]


@dataclass(frozen=True)
class Moments:
    """Row count, means and centred cross products of features, then targets."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    def merged(self, other: Moments) -> Moments:
        """Statistics of both sets of rows."""
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n),
                       self.scatter + other.scatter
                       + np.outer(gap, gap) * (self.n * (other.n / n)))


def _moments_of(rows: np.ndarray) -> Moments:
    mean = rows.mean(axis=0)
    centred = rows - mean
    return Moments(len(rows), mean, centred.T @ centred)


def _state_rows(states: Mapping[str, Moments]) -> pa.RecordBatch:
    keys = list(states)
    return pa.RecordBatch.from_arrays([
        pa.array(keys, pa.string()), pa.array([states[k].n for k in keys], pa.int64()),
        pa.array([states[k].mean.tobytes() for k in keys], pa.binary()),
        pa.array([states[k].scatter.tobytes() for k in keys], pa.binary())], _NAMES)


def _merged_states(batches: Iterator[pa.RecordBatch], into: dict[str, Moments]) -> None:
    for batch in batches:
        for grp, n, mean, scatter in zip(*(c.to_pylist() for c in batch.columns)):
            m = np.frombuffer(mean)
            state = Moments(n, m, np.frombuffer(scatter).reshape(len(m), len(m)))
            into[grp] = into[grp].merged(state) if grp in into else state


def matrix(column: pa.Array, width: int, complete: bool = True) -> np.ndarray:
    """Rows of a list column, each of ``width`` numbers, as a matrix (nulls as NaN, which
    raise if the rows must be ``complete``)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    if len(flat) != len(column) * width or complete and np.isnan(flat).any():
        raise ValueError("features and targets must be complete: null, NaN or of another width")
    return flat.reshape(len(column), width)


def as_array(df: DataFrame, features_col: str) -> Column:
    """A feature column, assembled vector or array, as an array."""
    if isinstance(df.schema[features_col].dataType, ArrayType):
        return F.col(features_col)
    return vector_to_array(features_col)


def state_rows(df: DataFrame, features_col: str, n_features: int, targets: Sequence[str],
               by: str | None = None) -> DataFrame:
    """Sets of statistics, at most ``MERGED`` of each group, from one scan of ``df``."""
    group = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    rows = df.select(group.alias("grp"), as_array(df, features_col).alias("x"),
                     F.array(*[F.col(t).cast("double") for t in targets]).alias("y"))
    n_targets = len(targets)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.hstack([matrix(batch.column(1), n_features),
                           matrix(batch.column(2), n_targets)])
            keys = np.array(batch.column(0).to_pylist(), dtype=object)
            for key in set(keys):
                part = _moments_of(z[keys == key])
                states[key] = states[key].merged(part) if key in states else part
        yield _state_rows(states)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, Moments] = {}
        _merged_states(batches, states)
        yield _state_rows(states)

    states = rows.mapInArrow(collect, _STATE)
    left = df.rdd.getNumPartitions()
    while left > MERGED:
        left = -(-left // MERGED)
        states = states.repartition(left).mapInArrow(merge, _STATE)
    return states


def moments(df: DataFrame, features_col: str, n_features: int, targets: Sequence[str],
            by: str | None = None) -> dict[str, Moments]:
    """Statistics of each value of ``by`` (of all rows, under ``""``, without it).

    One scan of ``df``.  Rows with a null or NaN feature or target raise.  Only sets of
    statistics leave a task and reach the driver.
    """
    states = state_rows(df, features_col, n_features, targets, by)
    out: dict[str, Moments] = {}
    _merged_states(iter(states.toArrow().to_batches()), out)
    return out


def _solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cholesky solution; without the directions of no variance where there are any."""
    try:
        low = np.linalg.cholesky(gram)
        if np.diag(low).min() > 1e-7:       # of correlations: diagonal of ones
            return np.linalg.solve(low.T, np.linalg.solve(low, right))
    except np.linalg.LinAlgError:
        pass
    e, u = np.linalg.eigh(gram)
    keep = e > e[-1] * len(e) * np.finfo(float).eps
    return u[:, keep] @ ((u[:, keep].T @ right) / e[keep, None])


def fit(stats: Moments, n_features: int, targets: Sequence[str],
        reg_param: float = 0.0) -> Coefficients:
    """``{target: (intercept, coefficients)}`` of every target from one set of statistics.

    The objective is that of Spark ML's ``LinearRegression`` with standardisation: squared
    error over 2 n plus ``reg_param`` / 2 times the squared standardised coefficients.
    Features of no variance get 0; a target of none is its intercept.  Collinear features
    share their weight (least norm) where a plain solution has none.
    """
    if not stats.n:
        raise ValueError("no rows to fit")
    x, y = slice(0, n_features), slice(n_features, None)
    sd = np.sqrt(np.diag(stats.scatter) / stats.n)
    noise = 1e-13 * np.maximum(np.abs(stats.mean), 1e-300)
    sd = np.where(sd > noise, sd, 0.0)
    live = np.flatnonzero(sd[x] > 0)
    out: Coefficients = {}
    one = np.where(sd > 0, sd, 1.0)
    corr = stats.scatter / stats.n / np.outer(one, one)
    gram, right = corr[np.ix_(live, live)], corr[x, y][live]
    plain = _solve(gram, right) if reg_param == 0 and len(live) else None
    for j, target in enumerate(targets):
        spread = sd[n_features + j]
        beta = np.zeros(n_features)
        if spread > 0 and len(live):
            std = plain[:, j] if plain is not None else _solve(
                gram + np.eye(len(live)) * (reg_param / spread), right[:, j:j + 1])[:, 0]
            beta[live] = std * spread / sd[live]
        out[target] = (float(stats.mean[n_features + j] - beta @ stats.mean[x]), beta.tolist())
    return out


def metrics(stats: Moments, coefs: Coefficients, n_features: int) -> dict[str, tuple]:
    """``{target: (rows, RMSE, R2)}`` on the rows of ``stats``; R2 is None without variance."""
    out = {}
    for j, (target, (intercept, beta)) in enumerate(coefs.items()):
        v = np.zeros(len(stats.mean))
        v[:n_features], v[n_features + j] = np.negative(beta), 1.0
        offset = v @ stats.mean - intercept
        error = max(0.0, v @ stats.scatter @ v) + stats.n * offset ** 2
        total = stats.scatter[n_features + j, n_features + j]
        out[target] = (stats.n, float(np.sqrt(error / stats.n)) if stats.n else None,
                       float(1 - error / total) if total > 0 else None)
    return out


def predictions(coefs: Coefficients, features: Column) -> dict[str, Column]:
    """A column per target: intercept plus the product with a feature array."""
    def of(intercept: float, beta: list[float]) -> Column:
        terms = F.zip_with(features, F.array(*map(F.lit, beta)), lambda a, b: a * b)
        return F.aggregate(terms, F.lit(float(intercept)), lambda s, t: s + t)
    return {t: of(*c) for t, c in coefs.items()}
