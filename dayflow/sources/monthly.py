"""Tables kept by month, of which an update rewrites only the months it touches.

``month`` (yyyyMM) is the partition column.  Updates read the touched months alone
(partition pruning), write the new rows aside and then replace those folders with a dynamic
partition overwrite; files of other months are not opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.operators.bitmaps import month_of
from dayflow.operators.panel import require_columns
from dayflow.session import materialize

MONTH = "month"


def write_monthly(df: DataFrame, path: str, date_col: str, mode: str = "errorifexists") -> str:
    """Write ``df`` with a folder a month; a month's rows are gathered (and split again by
    size where they are many) so that a folder holds few files."""
    rows = df.withColumn(MONTH, month_of(F.col(date_col).cast("date")))
    (rows.hint("rebalance", MONTH).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))
    return path


def read_monthly(spark: SparkSession, path: str, months: Sequence[int] | None = None) -> DataFrame:
    """The table, or only some months' folders."""
    out = spark.read.parquet(path)
    return out if months is None else out.filter(F.col(MONTH).isin(*map(int, months)))


def upsert_monthly(spark: SparkSession, path: str, updates: DataFrame, on: Sequence[str],
                   columns: Sequence[str], date_col: str) -> list[int]:
    """Set ``columns`` where ``updates`` has a row for the key, add rows of new keys.

    Returns the months rewritten: those of the updates.  Two updates for one key raise.
    Keys are not null.
    """
    require_columns(updates, [*on, *columns], "upsert_monthly updates")
    if date_col not in on:
        raise ValueError(f"upsert_monthly: {date_col} must be part of the key")
    n = F.count(F.lit(1))
    new = updates.groupBy(*on).agg(
        F.when(n > 1, F.raise_error(F.lit("upsert_monthly: more than one row for a key")))
        .otherwise(F.lit(True)).cast("boolean").alias("__hit"),
        *[F.max(c).alias(f"__new_{c}") for c in columns])
    new = materialize(new, "updates")
    # at most the months of the updates' calendar
    months = sorted(r[0] for r in new.select(month_of(F.col(date_col).cast("date"))).distinct()
                    .collect())
    if not months:
        return []
    now = read_monthly(spark, path, months).drop(MONTH)
    require_columns(now, [*on, *columns], "upsert_monthly target")
    merged = now.join(new, list(on), "full").select(*[
        F.when(F.col("__hit"), F.col(f"__new_{c}").cast(now.schema[c].dataType))
        .otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in now.columns])
    write_monthly(materialize(merged, "merged-months"), path, date_col, mode="overwrite")
    return months
