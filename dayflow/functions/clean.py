"""Typing and cleaning of raw (string / double) columns.

Spark 4 runs with ANSI mode on, so a plain ``cast`` of a malformed string
raises.  Every parse here is ``try_*`` guarded and validated by a pattern
first, which also keeps values beyond the int range (they become bigint).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The reference's validation rule for integer amounts.
DIGITS = r"^\d+$"
# Signed decimal amounts such as "-5", "1.50" or "1.0E7" (Java double text).
DECIMAL_AMOUNT = r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$"

MONEY = "decimal(18,2)"        # input amount type
MONEY_SUM = "decimal(38,2)"    # type of every money sum (exact, engine-independent)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_amount(c: str | Column, pattern: str = DIGITS, to: str = "bigint",
                 default: int | None = 0) -> Column:
    """Validate-then-parse: ``to`` value when ``c`` matches ``pattern`` else ``default``.

    A null input, and a well-formed value beyond the range of ``to`` (whose
    cast fails), take the default as well (the reference's ``na.fill`` step).
    """
    c = _c(c).cast("string")
    fallback = F.lit(default).cast(to) if default is not None else F.lit(None).cast(to)
    return F.when(c.rlike(pattern), F.coalesce(c.try_cast(to), fallback)).otherwise(fallback)


def money(c: str | Column) -> Column:
    """Amount as exact ``decimal(18,2)``."""
    return _c(c).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of amounts, typed ``decimal(38,2)``."""
    return F.sum(money(c)).cast(MONEY_SUM)


def cents(df: DataFrame, column: str) -> Column:
    """``money(column)`` as a bigint number of cents.

    A cast of a double to a decimal goes through its text.  A double below 10^12 that is the
    quotient of whole cents and 100 is that amount (15 digits tell decimals apart), so its
    cents are taken by arithmetic; every other value is cast.
    """
    cast = (money(column) * 100).cast("bigint")
    if not isinstance(df.schema[column].dataType, DoubleType):
        return cast
    value = F.col(column)
    near = F.floor(value * 100 + 0.5)
    return F.when((F.abs(value) < 1e12) & (near / 100 == value), near).otherwise(cast)


def cents_sum(c: str | Column) -> Column:
    """Exact sum of ``cents``, typed ``decimal(38,2)``: the amounts' ``money_sum``.

    Upper and lower bits are summed apart, both as bigint (enough for 8 * 10^9 of the
    largest amounts), and put together once a group.
    """
    c = _c(c)
    high = F.sum(F.shiftright(c, 30)).cast("decimal(19,0)")
    low = F.sum(c.bitwiseAND(F.lit(2 ** 30 - 1))).cast("decimal(19,0)")
    return ((high * F.lit(Decimal(2 ** 30)) + low) * F.lit(Decimal("0.01"))).cast(MONEY_SUM)


def to_day(c: str | Column) -> Column:
    """Timestamp / timestamp_ntz / date -> date."""
    return _c(c).cast("date")


def parse_yyyymmdd(c: str | Column) -> Column:
    """``yyyyMMdd`` int or string -> date (null when malformed)."""
    return F.try_to_date(_c(c).cast("string"), "yyyyMMdd")


def add_amounts(*cols: str | Column, coalesce_nulls: bool = False) -> Column:
    """Row-wise sum of amounts (``total_flow = purchase + redeem``).

    By default a null addend makes the row null (and SUM then skips it), as
    SQL ``a + b`` does; ``coalesce_nulls`` treats a missing addend as 0.
    """
    terms = [_c(c) for c in cols]
    if coalesce_nulls:
        terms = [F.coalesce(t, F.lit(0)) for t in terms]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out
