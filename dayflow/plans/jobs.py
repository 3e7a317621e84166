"""End-to-end forecasting job: train -> save -> load -> roll forward -> filled
feature matrix -> submission, as one distributed composition of the operators.

In the reference this is three scripts joined by hand-written CSV files, with
a driver loop that collects one prediction per target per day and rewrites the
lag cells of the next 14 rows.  Here the forecasts come from one distributed
rollout, are written into the horizon rows with one upsert, and the lag
columns of the filled matrix are recomputed by the same window used in
training - which yields exactly the cells the reference's loop rewrote.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY, MONEY_SUM, money, to_day
from dayflow.functions.fmt import yyyymmdd
from dayflow.operators import filters, model, panel, rollout
from dayflow.session import materialize
from dayflow.sources.models import load_models, save_models


def train_job(panel_df: DataFrame, keys: Sequence[str], date_col: str,
              spec: model.FeatureSpec, params: Mapping[str, object], models_dir: str,
              split_k: int = 5, split: Callable[[DataFrame], DataFrame] | None = None,
              first: _dt.date | None = None, last: _dt.date | None = None):
    """Fit one model per target on the train days, save the set, and return
    ``(models, test metrics per target)``.

    ``first`` / ``last`` bound the training days (closed) after the lags are
    built, so the window's first days keep their history.  ``split`` adds a
    ``split`` column of 'train' and 'test' (``model.split_time``,
    ``model.split_random``); by default every ``split_k``-th day is 'test'.
    """
    ff = model.complete_rows(model.feature_frame(panel_df, keys, date_col, spec), spec)
    if first is not None or last is not None:
        ff = ff.filter(filters.in_closed(ff, date_col, first or _dt.date.min,
                                         last or _dt.date(9999, 12, 30)))
    ff = split(ff) if split else model.split_mod(ff, date_col, split_k)
    data = materialize(model.assemble(ff, spec)
                       .select(*keys, date_col, "split", "features", *spec.targets),
                       "train-features")
    models = model.fit_targets(data.filter(F.col("split") == "train"), spec, params)
    save_models(models, models_dir, terms=spec.feature_names())
    pred = model.score_models(models, data.filter(F.col("split") == "test"), keys, date_col)
    return models, model.regression_metrics(pred, ["target"])


def forecast_job(panel_df: DataFrame, keys: Sequence[str], date_col: str,
                 spec: model.FeatureSpec, models_dir: str, horizon: int):
    """Load the model set (fails fast if one is missing), roll every series
    forward, and build the filled feature matrix.  Returns (forecasts, matrix).

    Each series' horizon starts after its own last day, in the forecasts and in
    the matrix alike.  The rollout runs once: its result is written and both
    outputs read it.
    """
    models = load_models(models_dir, spec.targets)
    fc = materialize(rollout.rollout_linear(panel_df, keys, date_col, spec,
                                            rollout.model_coefficients(models), horizon),
                     "forecasts")
    hist = panel_df.select(*keys, date_col,
                           *[F.col(t).cast("double").alias(t) for t in spec.targets])
    filled = panel.upsert(panel.horizon_union(hist, keys, date_col, horizon, per_key_end=True),
                          fc.select(*keys, date_col, *spec.targets), [*keys, date_col],
                          list(spec.targets))
    return fc, model.feature_frame(filled, keys, date_col, spec)


def panel_job(facts: DataFrame, profiles: DataFrame, entity: str, date_col: str,
              measures: Sequence[str], attribute: str, segments: Mapping[str, object],
              series: Sequence[DataFrame] = (), ratio: tuple[str, str] | None = None,
              sentinel: object = 2, last: _dt.date | None = None) -> DataFrame:
    """Raw tables to one global daily panel (``keys=[]``), written once.

    * ``facts``: rows of an entity and a day; missing ``measures`` count as 0;
    * ``profiles``: one row per entity; an entity without one, or without
      ``attribute``, takes ``sentinel``;
    * per day: exact sums of every measure, the number of rows in each of
      ``segments`` (output name -> attribute value) and, with ``ratio``
      (numerator and denominator among them), ``segment_ratio``;
    * ``series``: daily frames joined by day, then forward filled; with ``last``
      the panel is first extended to that day (other columns null there), so
      the fill covers a horizon.
    """
    typed = facts.select(entity, to_day(date_col).alias(date_col),
                         *[F.coalesce(money(m), F.lit(0).cast(MONEY)).alias(m)
                           for m in measures])
    joined = panel.left_join_sentinel(typed, profiles.select(entity, attribute), entity,
                                      {attribute: sentinel})
    day = joined.groupBy(date_col).agg(
        *[F.sum(m).cast(MONEY_SUM).alias(m) for m in measures],
        *[F.count_if(F.col(attribute) == F.lit(v)).alias(n) for n, v in segments.items()])
    if ratio:
        day = day.withColumn("segment_ratio", panel.guarded_ratio(F.col(ratio[0]),
                                                                  F.col(ratio[1])))
    day = materialize(day, "panel-days")
    if last is not None:
        end = day.select(F.max(date_col)).scalar()
        more = panel.date_spine(day.sparkSession, F.when(
            end < F.lit(last), F.sequence(F.date_add(end, 1), F.lit(last))), out=date_col)
        day = day.unionByName(more, allowMissingColumns=True)
    filled = [c for s in series for c in s.columns if c != date_col]
    day = panel.join_daily_series(day, series, date_col)
    if filled:
        day = panel.forward_fill(day, [], date_col, filled)
    return materialize(day, "panel")


def submission(forecasts: DataFrame, keys: Sequence[str], date_col: str,
               columns: Mapping[str, str], floor: float | None = None,
               first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
    """Horizon extract: rows of ``[first, last]`` (when given), keys, yyyyMMdd
    date, forecasts truncated to bigint (``columns``: output name -> target).
    Forecasts are not clamped unless ``floor`` is given (a linear model can
    forecast negative amounts)."""
    def value(t):
        c = F.col(t)
        return F.greatest(c, F.lit(float(floor))) if floor is not None else c
    if first is not None or last is not None:
        forecasts = forecasts.filter(filters.in_closed(
            forecasts, date_col, first or _dt.date.min, last or _dt.date(9999, 12, 30)))
    return forecasts.select(*keys, yyyymmdd(date_col).alias(date_col),
                            *[value(t).cast("bigint").alias(n) for n, t in columns.items()])
