"""Rollout of a linear autoregression as a linear recurrence in companion form.

The state of a series is its last ``max(lags)`` days of all targets.  One step is the
companion matrix times the state plus an input made of intercepts and date terms, so
step h is the state times the h-th power's target rows, plus the inputs of the days up to
h through the powers before.  The powers are the same for every series: all steps of all
series are one matrix product a batch, without a loop over days.  Inputs depend on the
days alone and are summed once per last day (at most the days of the calendar).

A step whose lags meet a missing day, a null or a NaN is null, and so are the steps that
read it: which steps are known follows from which days are, by the same recurrence.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructField, StructType

from dayflow.operators.model import FeatureSpec
from dayflow.session import materialize


def lag_matrices(spec: FeatureSpec, coefs: Mapping[str, tuple[float, Sequence[float]]],
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intercepts (T), date-term weights (T x D) and lag weights (max lag x T x T)."""
    targets = list(spec.targets)
    weights = np.array([list(coefs[t][1]) for t in targets], float)
    n_terms = len(spec.feature_names()) - len(spec.lag_columns())
    lags = np.zeros((max(spec.lags), len(targets), len(targets)))
    at = n_terms
    for m in spec.lag_measures:
        for i in spec.lags:
            lags[i - 1][:, targets.index(m)] += weights[:, at]
            at += 1
    return np.array([float(coefs[t][0]) for t in targets]), weights[:, :n_terms], lags


def powers(lags: np.ndarray, horizon: int) -> np.ndarray:
    """Target rows of the companion matrix's powers 0 to ``horizon``: (h, T, depth * T)."""
    depth, t, _ = lags.shape
    companion = np.zeros((depth * t, depth * t))
    companion[:t] = np.hstack(list(lags))
    companion[t:, :-t] = np.eye((depth - 1) * t)
    rows = [np.eye(t, depth * t)]
    for _ in range(horizon):
        rows.append(rows[-1] @ companion)
    return np.array(rows)


def inputs_through(rows: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    """What the inputs of days 1 to H add to each step: (H, T)."""
    h, t = inputs.shape
    impulse = rows[:, :, :t]
    return np.array([sum(impulse[s - k] @ inputs[k] for k in range(s + 1)) for s in range(h)])


def known_steps(days: np.ndarray, lags: Sequence[int], horizon: int) -> np.ndarray:
    """Which steps have all their lags; ``days[:, i]`` tells of the day ``i`` before the end."""
    out = np.zeros((len(days), horizon), bool)
    for h in range(horizon):
        out[:, h] = np.logical_and.reduce(
            [out[:, h - i] if i <= h else days[:, i - h - 1] for i in lags])
    return out


def companion_rollout(tail: DataFrame, keys: Sequence[str], date_col: str, spec: FeatureSpec,
                      coefs: Mapping[str, tuple[float, Sequence[float]]],
                      horizon: int) -> DataFrame:
    """Forecasts of every series of ``tail`` (its last days, unique per key and day)."""
    targets, depth = list(spec.targets), max(spec.lags)
    used = [targets.index(m) for m in spec.lag_measures]
    n_targets = len(targets)
    ends = tail.groupBy(*keys).agg(
        F.max(date_col).alias("__end"),
        F.collect_list(F.struct(F.unix_date(date_col).alias("day"),
                                F.array(*[F.col(t) for t in targets]).alias("v"))).alias("__days"))
    state = materialize(ends.filter(F.col("__end").isNotNull()), "rollout-state")
    # the horizons' days, at most the calendar's; their terms are the training expressions
    days = state.select(F.explode(F.sequence(F.date_add("__end", 1), F.date_add("__end", horizon)))
                        .alias("__day")).distinct()
    terms = spec.date_terms("__day")
    known = {r[0]: np.array(r[1:], float) for r in days.select(
        F.unix_date("__day"), *[terms[n] for n in spec.feature_names()[:len(terms)]]).collect()}
    intercepts, term_weights, lags = lag_matrices(spec, coefs)
    rows = powers(lags, horizon)
    response = rows[1:].reshape(horizon * n_targets, depth * n_targets).T
    given: dict[int, np.ndarray] = {}
    for (end,) in state.select(F.unix_date("__end")).distinct().collect():
        inputs = np.array([intercepts + term_weights @ known[end + s + 1] for s in range(horizon)])
        given[end] = inputs_through(rows, inputs).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            end = batch.column(len(keys)).cast(pa.int32()).to_numpy(zero_copy_only=False)
            nested = batch.column(len(keys) + 1)
            of = np.repeat(np.arange(n), np.asarray(nested.value_lengths()))
            flat = nested.flatten()
            back = end[of] - flat.field("day").to_numpy(zero_copy_only=False)
            values = flat.field("v").flatten().to_numpy(zero_copy_only=False).astype(
                float).reshape(len(of), n_targets)
            near = back < depth
            start = np.full((n, depth, n_targets), np.nan)
            start[of[near], back[near]] = values[near]
            steps = known_steps(~np.isnan(start[:, :, used]).any(axis=2), spec.lags, horizon)
            out = np.nan_to_num(start).reshape(n, -1) @ response
            out += np.array([given[e] for e in end])
            out = out.reshape(n, horizon, n_targets)
            again = pa.array(np.repeat(np.arange(n), horizon))
            step = np.tile(np.arange(1, horizon + 1, dtype=np.int32), n)
            date = pa.array((np.repeat(end, horizon) + step).astype(np.int32)).cast(pa.date32())
            blank = ~steps.ravel()
            yield pa.RecordBatch.from_arrays([
                *[batch.column(k).take(again) for k in range(len(keys))], date, pa.array(step),
                *[pa.array(out[:, :, j].ravel(), mask=blank) for j in range(n_targets)]],
                [*keys, date_col, "step", *targets])

    schema = StructType([*[state.schema[k] for k in keys], StructField(date_col, DateType()),
                         StructField("step", IntegerType()),
                         *[StructField(t, DoubleType()) for t in targets]])
    return state.select(*keys, "__end", "__days").mapInArrow(run, schema)
