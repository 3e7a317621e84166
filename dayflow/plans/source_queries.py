"""Source and sink round trips: raw all-string CSV scans cleaned into types,
declared-schema CSV scans, and CSV sinks in fail-if-exists and overwrite modes.

Each query writes below the session's shared checkpoint root in a fresh
directory and returns the lazily re-read result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dayflow.functions.clean import DECIMAL_AMOUNT, DIGITS, MONEY, parse_amount
from dayflow.plans.flow_queries import DAILY_FLOW_SQL, daily_flow, top_n
from dayflow.plans.inputs import table
from dayflow.plans.registry import register
from dayflow.session import scratch_path
from dayflow.sources.files import read_csv, string_schema, write_csv
from dayflow.streaming.daily_flow import (
    latest, run_complete_to_table, stream_daily_flow, table_stream,
)

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]
ORDER_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                "o_totalprice double, o_orderdate date")
DAILY_FLOW_SCHEMA = ("report_date date, total_purchase_amt decimal(38,2), "
                     "total_redeem_amt decimal(38,2)")


@register("src_csv_clean", """
SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events
""")
def src_csv_clean(spark, sf_dir):
    """Events as a header CSV read back all-string, then validated and typed."""
    path = scratch_path(spark, "events-csv")
    write_csv(table(spark, sf_dir, "events").select(*EVENT_COLUMNS), path)
    raw = read_csv(spark, path, string_schema(EVENT_COLUMNS))
    return raw.select(parse_amount("event_id", DIGITS, "bigint", None).alias("event_id"),
                      parse_amount("user_id", DIGITS, "bigint", None).alias("user_id"),
                      "event_type",
                      parse_amount("value", DECIMAL_AMOUNT, MONEY).alias("value"))


@register("src_csv_typed", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders
""")
def src_csv_typed(spark, sf_dir):
    """Orders as a header CSV read back with a declared schema (no inference pass)."""
    path = scratch_path(spark, "orders-csv")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"))
    write_csv(o, path)
    return read_csv(spark, path, ORDER_SCHEMA)


@register("sink_roundtrip_csv", DAILY_FLOW_SQL)
def sink_roundtrip_csv(spark, sf_dir):
    """Daily totals written with a header in fail-if-exists mode, read back typed."""
    path = scratch_path(spark, "daily-flow")
    write_csv(daily_flow(spark, sf_dir), path, mode="errorifexists")
    return read_csv(spark, path, DAILY_FLOW_SCHEMA)


@register("sink_roundtrip_overwrite", DAILY_FLOW_SQL)
def sink_roundtrip_overwrite(spark, sf_dir):
    """A first write (top-20 days) replaced by an overwrite of all daily totals."""
    path = scratch_path(spark, "daily-flow-ow")
    write_csv(top_n(spark, sf_dir), path)
    write_csv(daily_flow(spark, sf_dir), path, mode="overwrite")
    return read_csv(spark, path, DAILY_FLOW_SCHEMA)


@register("stream_daily_flow", DAILY_FLOW_SQL)
def stream_daily_flow_q(spark, sf_dir):
    """Daily totals maintained by a Structured Streaming query over the orders
    table, a file or a directory (availableNow trigger, checkpointed), read back from its result table."""
    src = table_stream(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    root = scratch_path(spark, "stream-daily-flow")
    run_complete_to_table(stream_daily_flow(src), f"{root}/table", f"{root}/checkpoint")
    return latest(spark, f"{root}/table")
