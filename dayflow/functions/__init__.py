"""Column-expression builders (JVM-side, whole-stage-codegen friendly)."""

from dayflow.functions.clean import (  # noqa: F401
    DECIMAL_AMOUNT, DIGITS, MONEY, MONEY_SUM, add_amounts, money, money_sum, parse_amount,
    parse_yyyymmdd, to_day,
)
from dayflow.functions.calendar import (  # noqa: F401
    HOLIDAYS_2013_2014, PI_APPROX, WORKDAY_OVERRIDES_2014, calendar_columns,
    holiday_flag, trend_columns, weekend_flag,
)
from dayflow.functions.fmt import format_amount, yyyymmdd  # noqa: F401
