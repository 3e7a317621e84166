"""Structured Streaming execution of the daily-flow operators.

The reference is batch-only; nothing here adds an operator.  The same
DataFrame operators (they never collect and never use RDDs) run unchanged on a
streaming DataFrame, so daily totals can be maintained incrementally as fact
files arrive.
"""

from dayflow.streaming.daily_flow import (  # noqa: F401
    file_stream, run_complete_to_table, stream_daily_flow,
)
