"""Exact-date lag features.

``lag_features`` reads, for every row (key, d), the measures of row
(key, d - i) for i in ``lags`` - null when that day is absent, so gaps in a
series never shift values the way ``lag()`` over rows would.  It is one
Window operator: every lag is a one-day RANGE frame over the same sort
(``partitionBy(keys).orderBy(unix_date(d))``), taking ``first`` of a struct
of all measures, so 14 lags x many measures cost one shuffle and one sort.

``lag_self_join`` is the reference's formulation - match each row with the
row of day ``d - i`` - kept as an independent cross-check.  By default it is
planned as ONE shuffle: every row is emitted once per lag shifted to ``d + i``,
unioned with the base rows and grouped by (keys, day); ``method="join"`` runs
the literal chain of one left join per lag (two shuffles per lag).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_LAGS = tuple(range(1, 15))
TWO_ROWS = "lags: more than one row for a key and day"


def lag_name(measure: str, i: int) -> str:
    return f"{measure}_{i}"


def lag_features(df: DataFrame, keys: Sequence[str], date_col: str,
                 measures: Sequence[str], lags: Sequence[int] = DEFAULT_LAGS) -> DataFrame:
    """Add ``<measure>_<i>`` = value of ``measure`` exactly ``i`` days earlier.

    ``df`` is a panel: one row per (keys, day), a second raises - aggregate facts
    first (a hot key then holds at most one row per day, so no window partition
    grows with the fact volume).
    """
    order = F.unix_date(F.col(date_col).cast("date"))
    base = Window.partitionBy(*keys).orderBy(order)
    packed = F.struct(*[F.col(m).alias(m) for m in measures])
    frames = {f"__lag{i}": F.first(packed).over(base.rangeBetween(-i, -i)) for i in lags}
    out = df.withColumns(frames | {"__same": F.count(F.lit(1)).over(base.rangeBetween(0, 0))})
    out = out.withColumn(date_col, F.when(F.col("__same") > 1, F.raise_error(F.lit(TWO_ROWS)))
                         .otherwise(F.col(date_col)))
    unpacked = [F.col(f"__lag{i}")[m].alias(lag_name(m, i)) for i in lags for m in measures]
    return out.select(*df.columns, *unpacked)


def lag_self_join(df: DataFrame, keys: Sequence[str], date_col: str,
                  measures: Sequence[str], lags: Sequence[int] = DEFAULT_LAGS,
                  method: str = "shift") -> DataFrame:
    """Same result as :func:`lag_features`, by exact-date matching of day ``d - i``."""
    if method == "shift":
        return _lag_shift_union(df, keys, date_col, measures, lags)
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    src = df.select(*keys, date_col, *measures)
    out = df
    for i in lags:
        shifted = src.select(*keys, F.date_add(F.col(date_col), i).alias(date_col),
                             *[F.col(m).alias(lag_name(m, i)) for m in measures])
        out = out.join(shifted, [*keys, date_col], "left")
    cols = [lag_name(m, i) for i in lags for m in measures]
    return out.select(*df.columns, *cols)


def _lag_shift_union(df: DataFrame, keys: Sequence[str], date_col: str,
                     measures: Sequence[str], lags: Sequence[int]) -> DataFrame:
    # one pass over the input: each row is emitted as itself (lag 0, carrying
    # every column) and once per lag shifted to day + i (carrying the measures)
    others = [c for c in df.columns if c not in (*keys, date_col)]
    copies = F.array(F.struct(F.lit(0).alias("lag"), F.col(date_col).alias("day")),
                     *[F.struct(F.lit(i).alias("lag"),
                                F.date_add(F.col(date_col), i).alias("day")) for i in lags])
    rows = df.select(*keys, *others, F.explode(copies).alias("__s"))
    is_base = (F.col("__s.lag") == 0)
    rows = rows.select(*keys, F.col("__s.day").alias(date_col),
                       F.col("__s.lag").alias("__lag"),
                       is_base.cast("int").alias("__base"),
                       *[F.when(is_base, F.col(c)).alias(c) for c in others],
                       *[F.when(~is_base, F.col(m)).alias(f"__m_{m}") for m in measures])
    n = F.sum("__base")
    grouped = rows.groupBy(*keys, date_col).agg(
        F.when(n > 1, F.raise_error(F.lit(TWO_ROWS)).cast("bigint")).otherwise(n)
        .alias("__base"),
        *[F.max_by(c, "__base").alias(c) for c in others],
        *[F.max(F.when(F.col("__lag") == i, F.col(f"__m_{m}"))).alias(lag_name(m, i))
          for i in lags for m in measures])
    cols = [lag_name(m, i) for i in lags for m in measures]
    return grouped.filter(F.col("__base") == 1).select(*df.columns, *cols)
