"""Exact distinct counts from mergeable state.

``count(DISTINCT ...)`` keeps nothing that a later month could be added to.  Two states
can be stored and merged without reading the facts again, and both are partially
aggregated before every shuffle:

* **day masks**: one integer per entity and month with a bit per day of the month
  (``bit_or``); the distinct days of any months are the sum of the masks' bits.  31 bits hold
  a month, so a mask is a fixed-width aggregate of 4 bytes and needs no bitmap of 4 KB.
* **entity bitmaps**: the distinct entities of a period as bitmaps of 32,768 neighbouring ids
  (``bitmap_construct_agg``); ``bitmap_or_agg`` merges periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """yyyyMM of a date as an integer."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def day_masks(facts: DataFrame, entity: str, day_col: str) -> DataFrame:
    """``(entity, month, mask)``: bit ``d - 1`` is set if the entity has a row on day ``d``.

    Rows without a day set no bit and make no row.
    """
    day = F.col(day_col).cast("date")
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)
    return (facts.filter(day.isNotNull())
            .groupBy(entity, month_of(day).alias("month")).agg(F.bit_or(bit).alias("mask")))


def merge_masks(masks: DataFrame, entity: str) -> DataFrame:
    """One mask per entity and month of the union of states."""
    return masks.groupBy(entity, "month").agg(F.bit_or("mask").alias("mask"))


def distinct_days(masks: DataFrame, entity: str, min_days: int = 1,
                  out: str = "active_days") -> DataFrame:
    """Entities with at least ``min_days`` distinct days over all months of ``masks``.

    States that hold a month twice (a late batch) may be given unmerged.
    """
    return (merge_masks(masks, entity).groupBy(entity)
            .agg(F.sum(F.bit_count("mask")).alias(out)).filter(F.col(out) >= F.lit(min_days)))


def entity_bitmaps(facts: DataFrame, entity: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by, bucket, bitmap)``: which entities (integer ids) have a row."""
    rows = facts.filter(F.col(entity).isNotNull())
    return rows.groupBy(*by, F.bitmap_bucket_number(entity).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(entity)).alias("bitmap"))


def distinct_entities(bitmaps: DataFrame, by: Sequence[str] = (),
                      out: str = "n_entities") -> DataFrame:
    """Distinct entities per ``by`` (of everything, without it) of stored bitmaps."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    n = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint")
    return merged.groupBy(*by).agg(n.alias(out))
