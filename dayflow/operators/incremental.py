"""Daily totals and their lags kept up to date as days arrive.

Totals are mergeable partial sums kept by month.  New facts, late ones included, change
the totals of their own days and the lags of the days up to ``max(lags)`` later; only the
months of these days are read and rewritten (dynamic partition overwrite), and of the
months before, the days that they look back at.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.operators.bitmaps import month_of
from dayflow.operators.flows import daily_totals
from dayflow.operators.lags import DEFAULT_LAGS, lag_features
from dayflow.session import materialize
from dayflow.sources.monthly import MONTH, read_monthly, write_monthly


def _months(days: Iterable[_dt.date]) -> list[int]:
    return sorted({d.year * 100 + d.month for d in days})


def _days_of(df: DataFrame, date_col: str) -> list[_dt.date]:
    """Distinct days: at most the calendar of the rows."""
    return sorted(r[0] for r in df.select(date_col).distinct().collect())


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def add_facts(spark: SparkSession, path: str, facts: DataFrame, date_col: str,
              measures: Mapping[str, Column | str], keys: Sequence[str] = ()) -> list[_dt.date]:
    """Add ``facts`` to the daily totals at ``path`` (made if absent); returns their days.

    Facts without a day are left out.  Adding the same facts again counts them again: the
    caller gives each batch once.
    """
    new = daily_totals(facts.filter(F.col(date_col).isNotNull()), date_col, measures, keys)
    new = materialize(new, "new-days")
    days = _days_of(new, date_col)
    if not days:
        return []
    if exists(spark, path):
        old = read_monthly(spark, path, _months(days)).select(*new.columns)
        merged = old.unionByName(new).groupBy(*keys, date_col).agg(*[
            F.sum(m).cast(new.schema[m].dataType).alias(m) for m in measures])
        new = materialize(merged, "merged-days")
    write_monthly(new, path, date_col, mode="overwrite")
    return days


def refresh_lags(spark: SparkSession, totals: str, path: str, date_col: str,
                 measures: Sequence[str], days: Sequence[_dt.date], keys: Sequence[str] = (),
                 lags: Sequence[int] = DEFAULT_LAGS) -> list[int]:
    """Bring the lag table at ``path`` up to date after ``days`` of ``totals`` changed.

    The months of ``days`` and of the days that look back at them are made again.  Returns
    these months (of days without totals there are no rows).
    """
    if not days:
        return []
    day = _dt.timedelta(days=1)
    months = _months({d + i * day for d in days for i in (0, *lags)})
    firsts = {_dt.date(m // 100, m % 100, 1) for m in months}
    before = _months({d - i * day for d in firsts for i in lags})
    rows = read_monthly(spark, totals, sorted({*months, *before}))
    # of the months before, only the days that a lag can reach
    reach = F.array(*[F.lit(d) for d in sorted(firsts)])
    near = F.col(MONTH).isin(*months) | F.exists(
        reach, lambda f: (F.col(date_col) < f) & (F.col(date_col) >= F.date_sub(f, max(lags))))
    made = lag_features(rows.filter(near).select(*keys, date_col, *measures), keys, date_col,
                        measures, lags)
    made = made.filter(month_of(F.col(date_col)).isin(*months))
    write_monthly(materialize(made, "lag-months"), path, date_col, mode="overwrite")
    return months
