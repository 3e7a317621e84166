"""Keyed daily panels: spines, sentinel joins, segment counts, forward fill,
horizon placeholders and bulk point overwrites.

A panel is a DataFrame keyed by ``keys + [date]``.  ``keys=()`` is the
reference's single global series; any number of series share the same code.

Scale notes
* Spines are generated per key row with ``explode`` of a day array - a
  Generate, not a cross join; output size is exactly keys x days.
  ``dense_panel`` generates them after the key shuffle, so they are never
  shuffled themselves.
* The day range is one scalar subquery returning the array of days (one narrow
  scan), evaluated once and inlined.
* Windows partition by the series keys.  With no keys the window holds one
  row per day (a days-sized, data-independent bound), never raw facts.
* Exogenous daily series are broadcast: one row per day, bounded by the
  calendar, not by the fact volume.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "operator") -> None:
    """Fail at plan-build time when expected columns are absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: unknown columns {missing}")


def _unique(count: Column, value: Column, what: str) -> Column:
    """``value``, or an error where ``count`` rows (more than one) stand for it."""
    return F.when(count > 1, F.raise_error(F.lit(f"{what}: more than one row for a key and day"))
                  ).otherwise(value)


def day_range(df: DataFrame, date_col: str, start_offset: int = 0, end_offset: int = 0,
              after_last: bool = False) -> Column:
    """Array of consecutive days as ONE scalar subquery (one scan of ``date_col``).

    Default: first day + ``start_offset`` .. last day + ``end_offset``.
    ``after_last``: last day + ``start_offset`` .. last day + ``end_offset``
    (a horizon).  The array has one element per day of the range: bounded by
    the calendar, not by the data volume.
    """
    d = F.col(date_col).cast("date")
    lo = F.max(d) if after_last else F.min(d)
    seq = F.sequence(F.date_add(lo, start_offset), F.date_add(F.max(d), end_offset))
    return df.select(seq).scalar()


def date_spine(spark: SparkSession, start: Column | str, end: Column | str | None = None,
               out: str = "report_date") -> DataFrame:
    """One row per day: of the inclusive range ``[start, end]``, or of a day array."""
    if end is None:
        days = start
    else:
        s = F.lit(start).cast("date") if isinstance(start, str) else start
        e = F.lit(end).cast("date") if isinstance(end, str) else end
        days = F.sequence(s, e)
    return spark.range(1).select(F.explode(days).alias(out))


def panel_spine(keys_df: DataFrame, keys: Sequence[str], days: Column,
                out: str = "report_date") -> DataFrame:
    """Every (key, day) for each distinct key row; ``days`` is an array of dates
    (see :func:`day_range`).  A Generate per key row, not a cross join."""
    ks = keys_df.select(*keys).distinct()
    return ks.select(*keys, F.explode(days).alias(out))


def _place(u: DataFrame, values: DataFrame, keys: Sequence[str], date_col: str,
           v_cols: Sequence[str], fill: Mapping[str, Any]) -> DataFrame:
    """Spine rows (``__spine``) + value rows -> one row per spine (key, day).

    Two value rows for one (key, day) raise."""
    aggs = []
    n_values = F.count_if(~F.col("__spine"))
    for c in v_cols:
        e = _unique(n_values, F.max(c), "panel values")
        if c in fill:
            e = F.coalesce(e, F.lit(fill[c]).cast(values.schema[c].dataType))
        aggs.append(e.alias(c))
    out = u.groupBy(*keys, date_col).agg(F.max("__spine").alias("__spine"), *aggs)
    return out.filter(F.col("__spine")).select(*keys, date_col, *v_cols)


def spine_join(spine: DataFrame, values: DataFrame, keys: Sequence[str], date_col: str,
               fill: Mapping[str, Any] | None = None) -> DataFrame:
    """Values placed on a (keys, day) spine: the spine LEFT JOIN values, with
    ``fill`` for the days a series has no value.  ``values`` must be unique per
    (keys, day) (an aggregated panel): a second row raises.

    Written as UNION ALL + group-by instead of a join: a join needs both sides
    hash-partitioned on *all* join keys (keys, day), while an aggregate and a
    later ``partitionBy(keys)`` window both accept a partitioning on the series
    keys alone - so the dense panel and the window over it share one shuffle.
    """
    fill = dict(fill or {})
    v_cols = [c for c in values.columns if c not in (*keys, date_col)]
    s = spine.select(*keys, date_col, F.lit(True).alias("__spine"),
                     *[F.lit(None).cast(values.schema[c].dataType).alias(c) for c in v_cols])
    v = values.select(*keys, date_col, F.lit(False).alias("__spine"), *v_cols)
    u = s.unionByName(v)
    if keys:
        u = u.repartition(*[F.col(k) for k in keys])
    return _place(u, values, keys, date_col, v_cols, fill)


def dense_panel(values: DataFrame, keys: Sequence[str], date_col: str, days: Column,
                fill: Mapping[str, Any] | None = None) -> DataFrame:
    """Every (key, day in ``days``) for each key of ``values``, with the values
    placed on it (``fill`` for days a series has no value).  ``values`` must be
    unique per (keys, day): a second row raises.  ``values`` is read for its
    keys and its rows: pass a written table, not an unwritten aggregate.  Same
    result as ``spine_join(panel_spine(...), ...)``.

    Only one marker row per key and the (sparse) values are shuffled; the spine
    is generated after the shuffle, inside each key's partition, so the
    keys x days rows never cross the network.  The aggregate and any later
    ``partitionBy(keys)`` window reuse that one partitioning.
    """
    if not keys:    # one global series: the spine is one row per day
        spine = values.sparkSession.range(1).select(F.explode(days).alias(date_col))
        return spine_join(spine, values, keys, date_col, fill)
    fill = dict(fill or {})
    v_cols = [c for c in values.columns if c not in (*keys, date_col)]
    date_t = values.schema[date_col].dataType
    markers = values.select(*keys).distinct().select(
        *keys, F.lit(None).cast(date_t).alias(date_col), F.lit(True).alias("__spine"),
        *[F.lit(None).cast(values.schema[c].dataType).alias(c) for c in v_cols])
    vals = values.select(*keys, date_col, F.lit(False).alias("__spine"), *v_cols)
    u = markers.unionByName(vals).repartition(*[F.col(k) for k in keys])
    u = u.select(*keys, F.explode(F.when(F.col("__spine"), days)
                                  .otherwise(F.array(F.col(date_col)))).alias(date_col),
                 "__spine", *v_cols)
    return _place(u, values, keys, date_col, v_cols, fill)


def left_join_sentinel(facts: DataFrame, dim: DataFrame, on: str | Sequence[str],
                       sentinels: Mapping[str, Any]) -> DataFrame:
    """Fact LEFT JOIN dimension; unmatched attribute values become sentinels."""
    joined = facts.join(dim, on, "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(joined.schema[c].dataType))
        for c, v in sentinels.items()
    })


def segment_counts(df: DataFrame, keys: Sequence[str], segment_col: str,
                   segments: Mapping[str, Any], weight: str | None = None) -> DataFrame:
    """Per key: number of rows in each named segment (``sum(when(seg = v, 1))``).

    With ``weight`` each row counts as that many rows (a pre-aggregated count).
    """
    one = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(segment_col) == F.lit(v), one).otherwise(F.lit(0).cast("bigint")))
         .alias(name)
        for name, v in segments.items()
    ])


def guarded_ratio(num: Column, den: Column, default: float = 3.0) -> Column:
    """``num / den``, or ``default`` when the denominator is 0 (ANSI-safe)."""
    return (F.when(den != 0, num.cast("double") / den.cast("double"))
             .otherwise(F.lit(default).cast("double")))


def forward_fill(df: DataFrame, keys: Sequence[str], order_col: str,
                 columns: Sequence[str]) -> DataFrame:
    """Each column's last non-null value up to the current row, per series.

    Meant for panels (one row per series and day), so a window partition is
    bounded by the number of days.  Unknown column names raise (the reference
    silently skipped a misspelt one).
    """
    require_columns(df, [*keys, order_col, *columns], "forward_fill")
    w = (Window.partitionBy(*keys).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def join_daily_series(panel: DataFrame, series: Sequence[DataFrame],
                      date_col: str) -> DataFrame:
    """Left-join exogenous daily series onto a panel.

    A series has one row per day; a second row for a day raises, and its
    ``date_col`` must be a date.  So the broadcast side is bounded by the number
    of calendar days in its range - a bound that does not grow with the fact
    data - and the panel is never shuffled for it.
    """
    out = panel
    for s in series:
        if not isinstance(s.schema[date_col].dataType, DateType):
            raise ValueError(f"join_daily_series: {date_col} must be a date, not "
                             f"{s.schema[date_col].dataType.simpleString()}")
        vals = [c for c in s.columns if c != date_col]
        n = F.count(F.lit(1))
        per_day = s.groupBy(date_col).agg(*[_unique(n, F.max(c), "daily series").alias(c)
                                            for c in vals])
        out = out.join(F.broadcast(per_day), date_col, "left")
    return out


def horizon_rows(history: DataFrame, keys: Sequence[str], date_col: str, horizon: int,
                 fill: Mapping[str, Any] | None = None, per_key_end: bool = False) -> DataFrame:
    """Placeholder rows for the ``horizon`` days after the last observed day.

    By default the horizon starts after the global last day (one shared
    forecast window); ``per_key_end`` starts each series after its own last day.
    Value columns are null unless ``fill`` gives a placeholder.
    """
    fill = dict(fill or {})
    if per_key_end:
        ends = history.groupBy(*keys).agg(F.max(date_col).alias("__end"))
        base = ends.select(*keys, F.explode(F.sequence(F.date_add("__end", 1),
                                                       F.date_add("__end", horizon)))
                           .alias(date_col))
    else:
        days = day_range(history, date_col, 1, horizon, after_last=True)
        base = history.select(*keys).distinct().select(*keys, F.explode(days).alias(date_col))
    values = [c for c in history.columns if c not in (*keys, date_col)]
    return base.select(*keys, date_col, *[
        F.lit(fill.get(c)).cast(history.schema[c].dataType).alias(c) for c in values])


def horizon_union(history: DataFrame, keys: Sequence[str], date_col: str, horizon: int,
                  fill: Mapping[str, Any] | None = None, per_key_end: bool = False) -> DataFrame:
    """History UNION ALL (by name) the horizon placeholder rows."""
    return history.unionByName(
        horizon_rows(history, keys, date_col, horizon, fill, per_key_end))


def upsert(df: DataFrame, updates: DataFrame, on: Sequence[str],
           columns: Sequence[str]) -> DataFrame:
    """Bulk point overwrite: where ``updates`` has a row for the key, take its values.

    One left join replaces a chain of ``when(key == k, v)`` rewrites (one
    projection per point in the reference's loop).  Two updates for one key raise.
    """
    require_columns(df, [*on, *columns], "upsert target")
    require_columns(updates, [*on, *columns], "upsert updates")
    n = F.count(F.lit(1))
    u = updates.groupBy(*on).agg(_unique(n, F.lit(True), "upsert updates").alias("__hit"),
                                 *[F.max(c).alias(f"__new_{c}") for c in columns])
    joined = df.join(u, list(on), "left")
    return joined.withColumns({
        c: F.when(F.col("__hit"), F.col(f"__new_{c}").cast(df.schema[c].dataType))
            .otherwise(F.col(c))
        for c in columns
    }).select(*df.columns)
