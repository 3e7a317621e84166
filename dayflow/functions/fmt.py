"""Presentation formats, applied only at sinks (formatted text no longer sorts or sums)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yyyymmdd(c: str | Column, as_long: bool = False) -> Column:
    """Render a date as ``yyyyMMdd`` text, or as a bigint when ``as_long``."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.date_format(c, "yyyyMMdd")
    return s.cast("bigint") if as_long else s


def format_amount(c: str | Column, decimals: int = 2) -> Column:
    """Thousands-separated text, ``decimals`` places (``format_number``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_number(c, decimals)
