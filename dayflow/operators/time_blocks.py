"""Forward fill and exact lags of long series on many tasks.

A window partitioned by the series keys runs a whole series in one task; with no keys that
is the whole table.  Here a series is cut into blocks of its order column:

* **fill**: inside a block as usual; what a block's first rows need from before is carried:
  the last value of each block, scanned over the blocks, which is again a blocked scan
  with blocks for rows.  Every level divides the number of rows by ``BLOCK``, until one
  block holds them all.
* **lags**: every row is also sent, as a halo row, to the later blocks that look back at
  it; the blocks' windows then need nothing else.

No window is partitioned by the series keys alone, and no group holds more than a block (and
its halo) of a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from dayflow.operators.lags import DEFAULT_LAGS, TWO_ROWS, lag_name
from dayflow.operators.panel import require_columns

BLOCK = 4096        # units of the order column in a block


def units(df: DataFrame, order_col: str) -> Column:
    """The order column as whole units: days of a date, seconds of a timestamp, integers."""
    kind = df.schema[order_col].dataType
    c = F.col(order_col)
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_seconds(c.cast("timestamp"))
    if isinstance(kind, IntegralType):
        return c.cast("bigint")
    raise ValueError(f"{order_col}: {kind.simpleString()} has no units to cut blocks by")


def _block(unit: Column, width: int) -> Column:
    """Floor of ``unit / width``, in whole numbers."""
    return F.call_function("div", unit - F.pmod(unit, F.lit(width)), F.lit(width))


def _last(column: str, order: str) -> Column:
    """The non-null value of the greatest order."""
    return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(order)))


def _before(carried: DataFrame, keys: Sequence[str], columns: Sequence[str], width: int,
            blocks: int) -> DataFrame:
    """``carried`` (keys, ``__block`` from 0 to below ``blocks``, one value per block) with
    each block's last non-null value of the blocks before it."""
    rows = carried.withColumn("__super", _block(F.col("__block"), width).cast("bigint"))
    w = (Window.partitionBy(*keys, "__super").orderBy("__block")
         .rowsBetween(Window.unboundedPreceding, -1))
    inside = rows.select(*keys, "__super", "__block", *[
        F.last(c, ignorenulls=True).over(w).alias(c) for c in columns])
    if blocks <= width:
        return inside.drop("__super")
    supers = rows.groupBy(*keys, "__super").agg(*[_last(c, "__block").alias(c) for c in columns])
    above = _before(supers.withColumnRenamed("__super", "__block"), keys, columns, width,
                    -(-blocks // width))
    above = above.select(*keys, F.col("__block").alias("__super"),
                         *[F.col(c).alias(f"__a_{c}") for c in columns])
    return inside.join(above, [*keys, "__super"]).select(*keys, "__block", *[
        F.coalesce(c, f"__a_{c}").alias(c) for c in columns])


def blocked_forward_fill(df: DataFrame, keys: Sequence[str], order_col: str,
                         columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """The result of :func:`~dayflow.operators.panel.forward_fill` with a series on many tasks.

    Rows of one series and one unit of the order column are ordered by the column itself;
    equal ones take any order, as in the unblocked form.  Rows without an order come first,
    in a block of their own.  Null keys are a series.  The range of the order column is
    read once, to number the blocks from its start.
    """
    require_columns(df, [*keys, order_col, *columns], "blocked_forward_fill")
    names = {k: f"__k{i}" for i, k in enumerate(keys)}      # null keys join as structs
    unit = units(df, order_col)
    low, high = df.agg(F.min(unit), F.max(unit)).first()
    at = F.coalesce(_block(unit - F.lit(low or 0).cast("bigint"), block) + 1,
                    F.lit(0)).cast("bigint")
    blocks = ((high or 0) - (low or 0)) // block + 2
    rows = df.withColumns({"__block": at, **{n: F.struct(F.col(k).alias("k")) for k, n in
                                             names.items()}})
    held = list(names.values())
    w = (Window.partitionBy(*held, "__block").orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    carried = rows.groupBy(*held, "__block").agg(*[_last(c, order_col).alias(c) for c in columns])
    before = _before(carried, held, columns, max(2, block), blocks).select(
        *held, "__block", *[F.col(c).alias(f"__b_{c}") for c in columns])
    out = filled.join(before, [*held, "__block"])
    return out.withColumns({c: F.coalesce(c, f"__b_{c}") for c in columns}).select(*df.columns)


def blocked_lag_features(df: DataFrame, keys: Sequence[str], order_col: str,
                         measures: Sequence[str], lags: Sequence[int] = DEFAULT_LAGS,
                         block: int = BLOCK) -> DataFrame:
    """The result of :func:`~dayflow.operators.lags.lag_features` with a series on many tasks.

    Lags are in units of the order column (days of a date).  One row per (keys, unit); a
    second raises.  A row is sent to its own block and to those up to ``max(lags)`` units
    later, so one shuffle serves all lags; rows without an order have no lags.
    """
    require_columns(df, [*keys, order_col, *measures], "blocked_lag_features")
    unit = units(df, order_col)
    own = _block(unit, block).cast("bigint")
    last = _block(unit + max(lags), block).cast("bigint")
    blocks = F.when(unit.isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(
        F.sequence(own, last))
    rows = df.withColumn("__u", unit).select("*", F.posexplode(blocks).alias("__halo", "__block"))
    w = Window.partitionBy(*keys, "__block").orderBy("__u")
    packed = F.struct(*[F.col(m).alias(m) for m in measures])
    known = F.col("__u").isNotNull()
    cols = {f"__lag{i}": F.when(known, F.first(packed).over(w.rangeBetween(-i, -i))) for i in lags}
    out = rows.withColumns(cols | {"__same": F.when(known, F.count(F.lit(1)).over(
        w.rangeBetween(0, 0)))}).filter("__halo = 0")
    checked = F.when(F.col("__same") > 1, F.raise_error(F.lit(TWO_ROWS)).cast(
        df.schema[order_col].dataType)).otherwise(F.col(order_col))
    return out.withColumn(order_col, checked).select(*df.columns, *[
        F.col(f"__lag{i}")[m].alias(lag_name(m, i)) for i in lags for m in measures])
