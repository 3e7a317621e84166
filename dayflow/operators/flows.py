"""Daily totals, active-entity counts, group averages and rankings.

Scale notes
* Every aggregate here is decomposable (sum / count / min / max), so Spark
  runs a partial aggregate before the shuffle: a hot key (one day or one
  user holding a third of the rows) leaves each map task as one row.
* Distinct counting first reduces to distinct (entity, day) pairs, again with
  a map-side partial aggregate, then counts per entity.
* Fact x dimension flows are aggregated per entity *before* the join when the
  grouping attribute belongs to the dimension; the join then sees one row per
  entity instead of one per event.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY, MONEY_SUM


def daily_totals(facts: DataFrame, date_col: str, measures: Mapping[str, Column | str],
                 keys: Sequence[str] = (), money: bool = True) -> DataFrame:
    """``groupBy(keys + date)`` sums of each measure (nulls count as 0).

    With ``money`` the measures are summed exactly as ``decimal(18,2)`` and the
    sums typed ``decimal(38,2)``.
    """
    aggs = []
    for name, expr in measures.items():
        e = F.col(expr) if isinstance(expr, str) else expr
        if money:
            aggs.append(F.sum(F.coalesce(e.cast(MONEY), F.lit(0).cast(MONEY)))
                        .cast(MONEY_SUM).alias(name))
        else:
            aggs.append(F.sum(F.coalesce(e, F.lit(0))).alias(name))
    return facts.groupBy(*keys, date_col).agg(*aggs)


def active_days(facts: DataFrame, entity: str, day_col: str, min_days: int = 5,
                out: str = "active_days", approx_rsd: float | None = None) -> DataFrame:
    """Entities with at least ``min_days`` distinct active days (``>=``, as in the reference).

    Exact by default (distinct (entity, day) pairs, partially aggregated before
    the shuffle).  ``approx_rsd`` uses ``approx_count_distinct`` instead: a
    mergeable HyperLogLog++ sketch per entity, relative standard deviation
    ``approx_rsd``.
    """
    if approx_rsd is not None:
        cnt = F.approx_count_distinct(day_col, rsd=approx_rsd)
        return (facts.groupBy(entity).agg(cnt.alias(out))
                     .filter(F.col(out) >= F.lit(min_days)))
    per_day = facts.select(entity, day_col).distinct()
    return (per_day.groupBy(entity).agg(F.count(F.lit(1)).alias(out))
                   .filter(F.col(out) >= F.lit(min_days)))


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """One-row DataFrame with the row count (the ``count()`` action as a plan)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def exact_avg(value: Column, scale: int = 2) -> Column:
    """Average of values with at most ``scale`` decimals: exact decimal sum, then
    one double division (null without values).

    Bit-for-bit reproducible across engines and partitionings, unlike a double
    running sum whose last bits depend on the order of addition.  Values are
    rounded to ``scale`` first: 2 fits money; give rates and yields their own.
    """
    n = F.count(value)
    return F.when(n > 0, F.sum(value.cast(f"decimal({16 + scale},{scale})")).cast("double") / n)


def avg_by_group(joined: DataFrame, group_col: str, value_col: str,
                 out: str = "avg_value", weight: str | None = None,
                 scale: int = 2) -> DataFrame:
    """``groupBy(group).agg(avg(value))`` with the exact average.

    With ``weight`` each row stands for that many rows (a pre-aggregated count):
    ``sum(value * n) / sum(n)``, still exact.  Null values count in neither sum.
    """
    if weight is None:
        return joined.groupBy(group_col).agg(exact_avg(F.col(value_col), scale).alias(out))
    value = F.col(value_col).cast(f"decimal({16 + scale},{scale})")
    n = F.when(value.isNotNull(), F.col(weight).cast("bigint"))
    total = F.sum(n)
    return joined.groupBy(group_col).agg(
        F.when(total > 0, F.sum(value * n).cast("double") / total).alias(out))


def flow_by_entity(facts: DataFrame, entity: str, flow: Column, dim: DataFrame,
                   dim_key: str, attrs: Sequence[str], out: str = "total_flow") -> DataFrame:
    """Sum of a flow per (entity, dimension attributes), inner fact x dimension join.

    Aggregates the fact per entity first (partial aggregate before the
    shuffle), then attaches the attributes: the join sees one row per entity.
    Requires ``dim_key`` to be unique in ``dim`` (a dimension table).
    """
    per_entity = facts.groupBy(entity).agg(F.sum(flow).cast(MONEY_SUM).alias(out))
    d = dim.select(F.col(dim_key).alias(entity), *attrs)
    return per_entity.join(d, entity, "inner")


def top_k_per_group(df: DataFrame, group_col: str, order_col: str, k: int,
                    tie_break: Sequence[str] = (), descending: bool = True,
                    rank_col: str = "rank") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY g ORDER BY v DESC, tie_break) <= k``.

    The ``rank <= k`` filter lets Spark plan a partial WindowGroupLimit before
    the shuffle, so a huge group ships at most k rows per map task.  The
    tie-break columns make the choice among equal values deterministic.
    """
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(group_col).orderBy(o, *[F.col(c).asc() for c in tie_break])
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= F.lit(k)))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global first-n rows by an ordering (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
