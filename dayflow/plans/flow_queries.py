"""Flow queries: daily totals, active users, city averages, top-k (the first two
reference jobs), and the string / date / cleaning building blocks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from dayflow.functions.clean import (
    DIGITS, MONEY_SUM, add_amounts, parse_amount, parse_yyyymmdd, to_day,
)
from dayflow.functions.fmt import format_amount, yyyymmdd
from dayflow.operators import filters, flows
from dayflow.operators.sql import run_sql, temp_views
from dayflow.plans.inputs import order_flows, table
from dayflow.plans.registry import register

# Parameters of the flow jobs on the driver tables.
ACTIVE_MONTH = "2024-01"        # events month for active users
ACTIVE_MIN_DAYS = 12            # users have 4-17 purchase days in the month
BALANCE_DAY = _dt.date(1998, 3, 1)
FLOW_MONTH = "2000-08"
TOP_K = 3
TOP_N = 20

# --- SQL fragments shared by the oracles ------------------------------------
_PURCHASE = ("CASE WHEN o_orderstatus IN ('O','P') THEN CAST(o_totalprice AS DECIMAL(18,2)) "
             "ELSE 0 END")
_REDEEM = ("CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) "
           "ELSE 0 END")

DAILY_FLOW_SQL = f"""
SELECT CAST(o_orderdate AS DATE) AS report_date,
       CAST(SUM({_PURCHASE}) AS DECIMAL(38,2)) AS total_purchase_amt,
       CAST(SUM({_REDEEM}) AS DECIMAL(38,2)) AS total_redeem_amt
FROM orders GROUP BY CAST(o_orderdate AS DATE)
"""

ACTIVE_SQL = """
SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days
FROM events
WHERE event_type = 'purchase' AND strftime(ts, '%Y-%m') = '2024-01'
GROUP BY user_id
HAVING COUNT(DISTINCT CAST(ts AS DATE)) >= 12
"""

USER_FLOW_SQL = f"""
SELECT c.c_nationkey AS city_id, o.o_custkey AS user_id,
       CAST(SUM({_PURCHASE} + {_REDEEM}) AS DECIMAL(38,2)) AS total_flow
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE strftime(o.o_orderdate, '%Y%m%d') LIKE '200008%'
GROUP BY c.c_nationkey, o.o_custkey
"""

TOPK_SQL = f"""
SELECT city_id, user_id, total_flow, CAST(rn AS INTEGER) AS rank FROM (
  SELECT city_id, user_id, total_flow,
         ROW_NUMBER() OVER (PARTITION BY city_id ORDER BY total_flow DESC, user_id) AS rn
  FROM ({USER_FLOW_SQL}) f
) ranked WHERE rn <= 3
"""


def _order_flows(spark, sf_dir):
    return order_flows(table(spark, sf_dir, "orders"))


@register("daily_flow", DAILY_FLOW_SQL + " ORDER BY report_date")
def daily_flow(spark, sf_dir):
    """Daily purchase / redeem totals, ordered by day."""
    return (flows.daily_totals(_order_flows(spark, sf_dir), "report_date",
                               {"total_purchase_amt": "purchase",
                                "total_redeem_amt": "redeem"})
            .orderBy("report_date"))


def _active(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ev = filters.month_filter(ev.filter(F.col("event_type") == "purchase"), "ts",
                              ACTIVE_MONTH)
    return flows.active_days(ev.select("user_id", to_day("ts").alias("report_date")),
                             "user_id", "report_date", ACTIVE_MIN_DAYS)


@register("active_days_per_user", ACTIVE_SQL)
def active_days_per_user(spark, sf_dir):
    """Users with >= 12 distinct purchase days in January 2024."""
    return _active(spark, sf_dir)


@register("active_users_count",
          f"SELECT COUNT(*) AS active_user_count FROM ({ACTIVE_SQL}) a")
def active_users_count(spark, sf_dir):
    """Number of such users, as a one-row frame."""
    return flows.row_count(_active(spark, sf_dir), "active_user_count")


@register("avg_balance_by_city", """
SELECT c.c_nationkey AS city_id,
       CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(c.c_acctbal)
         AS avg_balance
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE CAST(o.o_orderdate AS DATE) = DATE '1998-03-01'
GROUP BY c.c_nationkey
ORDER BY avg_balance DESC
""")
def avg_balance_by_city(spark, sf_dir):
    """Average customer balance per city over the orders of one day."""
    orders = table(spark, sf_dir, "orders")
    day = orders.filter(filters.in_closed(orders, "o_orderdate", BALANCE_DAY, BALANCE_DAY))
    # one row per customer before the join (a customer with many orders that
    # day is one weighted row), then the exact weighted average per city
    per_cust = day.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    cust = table(spark, sf_dir, "customer")
    joined = per_cust.join(
        cust.select(F.col("c_custkey").alias("o_custkey"),
                    F.col("c_nationkey").alias("city_id"), "c_acctbal"),
        "o_custkey", "inner")
    return (flows.avg_by_group(joined, "city_id", "c_acctbal", "avg_balance", weight="n")
            .orderBy(F.col("avg_balance").desc()))


def _user_month_flow(spark, sf_dir):
    fl = filters.month_filter(_order_flows(spark, sf_dir), "o_orderdate", FLOW_MONTH)
    cust = table(spark, sf_dir, "customer")
    out = flows.flow_by_entity(fl, "user_id", add_amounts("purchase", "redeem"), cust,
                               "c_custkey", [F.col("c_nationkey").alias("city_id")])
    return out.select("city_id", "user_id", "total_flow")


@register("user_month_flow", USER_FLOW_SQL)
def user_month_flow(spark, sf_dir):
    """Per (city, user): total flow (purchase + redeem) in August 2000."""
    return _user_month_flow(spark, sf_dir)


def _topk(spark, sf_dir):
    return flows.top_k_per_group(_user_month_flow(spark, sf_dir), "city_id", "total_flow",
                                 TOP_K, tie_break=["user_id"])


@register("topk_per_group", TOPK_SQL)
def topk_per_group(spark, sf_dir):
    """Top 3 users per city by monthly flow (ties broken by user id)."""
    return _topk(spark, sf_dir)


@register("format_amount", f"""
SELECT city_id, user_id, rank,
       format('{{:,.0f}}', total_flow) AS total_flow_0,
       format('{{:,.2f}}', total_flow) AS total_flow_2
FROM ({TOPK_SQL}) t
""")
def format_amount_q(spark, sf_dir):
    """The top-k listing with amounts rendered as thousands-separated text."""
    return _topk(spark, sf_dir).select(
        "city_id", "user_id", "rank",
        format_amount("total_flow", 0).alias("total_flow_0"),
        format_amount("total_flow", 2).alias("total_flow_2"))


@register("top_n", DAILY_FLOW_SQL + " ORDER BY total_purchase_amt DESC, report_date LIMIT 20")
def top_n(spark, sf_dir):
    """The 20 days with the largest purchase total (a top-n report)."""
    return flows.top_n(daily_flow(spark, sf_dir),
                       [F.col("total_purchase_amt").desc(), F.col("report_date")], TOP_N)


@register("month_filter", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS report_date
FROM orders WHERE substr(strftime(o_orderdate, '%Y%m%d'), 1, 6) = '200008'
""")
def month_filter(spark, sf_dir):
    """Orders of one month, as a pushable half-open range on the date."""
    o = filters.month_filter(table(spark, sf_dir, "orders"), "o_orderdate", FLOW_MONTH)
    return o.select("o_orderkey", "o_custkey", to_day("o_orderdate").alias("report_date"))


@register("like_prefix", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS report_date, o_orderpriority
FROM orders
WHERE strftime(o_orderdate, '%Y%m%d') LIKE '200008%' AND o_orderpriority LIKE '1-%'
""")
def like_prefix(spark, sf_dir):
    """LIKE-prefix predicates: a yyyyMM prefix on the date and a text prefix."""
    o = table(spark, sf_dir, "orders")
    o = filters.prefix_filter(o, "o_orderdate", "200008")
    o = filters.prefix_filter(o, "o_orderpriority", "1-")
    return o.select("o_orderkey", yyyymmdd("o_orderdate").alias("report_date"),
                    "o_orderpriority")


@register("date_range_filter", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date,
       CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS ymd
FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
""")
def date_range_filter(spark, sf_dir):
    """Closed date range [1998-01-01, 1998-12-31], pushed to the scan."""
    o = table(spark, sf_dir, "orders")
    o = o.filter(filters.in_closed(o, "o_orderdate", _dt.date(1998, 1, 1),
                                   _dt.date(1998, 12, 31)))
    d = to_day("o_orderdate")
    return o.select("o_orderkey", d.alias("report_date"),
                    yyyymmdd(d, as_long=True).alias("ymd"))


@register("month_key", """
SELECT substr(strftime(o_orderdate, '%Y%m%d'), 1, 6) AS month_key, COUNT(*) AS n_orders
FROM orders GROUP BY 1
""")
def month_key(spark, sf_dir):
    """Orders per yyyyMM month key."""
    o = table(spark, sf_dir, "orders")
    return (o.select(F.date_format("o_orderdate", "yyyyMM").alias("month_key"))
             .groupBy("month_key").agg(F.count(F.lit(1)).alias("n_orders")))


@register("parse_dates", """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS ymd,
       CAST(o_orderdate AS DATE) AS report_date,
       CAST(NULL AS DATE) AS bad_date
FROM orders
""")
def parse_dates(spark, sf_dir):
    """yyyyMMdd integers parsed back to dates; malformed text parses to null."""
    o = table(spark, sf_dir, "orders")
    ymd = o.select(yyyymmdd("o_orderdate", as_long=True).alias("ymd")).distinct()
    return ymd.select("ymd", parse_yyyymmdd("ymd").alias("report_date"),
                      parse_yyyymmdd(F.concat(F.col("ymd").cast("string"), F.lit("x")))
                      .alias("bad_date"))


@register("flow_expr", f"""
SELECT o_orderkey, CAST({_PURCHASE} + {_REDEEM} AS DECIMAL(38,2)) AS total_flow
FROM orders
""")
def flow_expr(spark, sf_dir):
    """Per-row total flow = purchase + redeem."""
    fl = order_flows(table(spark, sf_dir, "orders"), keep=("o_orderkey",))
    return fl.select("o_orderkey",
                     add_amounts("purchase", "redeem").cast(MONEY_SUM).alias("total_flow"))


@register("clean_numeric", """
SELECT event_id,
       CASE WHEN regexp_matches(regexp_extract(props, '(\\d+)', 1), '^\\d+$')
            THEN COALESCE(TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT), 0)
            ELSE 0 END AS k,
       CASE WHEN regexp_matches(props, '^\\d+$') THEN COALESCE(TRY_CAST(props AS BIGINT), 0)
            ELSE 0 END AS props_num
FROM events
""")
def clean_numeric(spark, sf_dir):
    """Validate-then-parse of text amounts: digits parse, anything else becomes 0."""
    ev = table(spark, sf_dir, "events")
    k_text = F.regexp_extract("props", r"(\d+)", 1)
    return ev.select("event_id", parse_amount(k_text, DIGITS).alias("k"),
                     parse_amount("props", DIGITS).alias("props_num"))


# --- the same jobs as SQL text (S3, S4) -----------------------------------------
@register("sql_topk_per_group", TOPK_SQL)
def sql_topk_per_group(spark, sf_dir):
    """Top 3 users per city by August-2000 flow, written as parameterised SQL text
    over DataFrame bindings."""
    text = """
    WITH per_user AS (             -- one row per user before the dimension join
      SELECT user_id, SUM(purchase + redeem) AS flow
      FROM {flows}
      WHERE o_orderdate >= CAST(:start AS TIMESTAMP_NTZ)
        AND o_orderdate < CAST(:stop AS TIMESTAMP_NTZ)
      GROUP BY user_id)
    SELECT city_id, user_id, total_flow, rank FROM (
      SELECT c.c_nationkey AS city_id, p.user_id,
             CAST(p.flow AS DECIMAL(38,2)) AS total_flow,
             ROW_NUMBER() OVER (PARTITION BY c.c_nationkey
                                ORDER BY p.flow DESC, p.user_id) AS rank
      FROM per_user p JOIN {customer} c ON p.user_id = c.c_custkey) ranked
    WHERE rank <= :k
    """
    return run_sql(spark, text, {"start": "2000-08-01", "stop": "2000-09-01", "k": TOP_K},
                   flows=_order_flows(spark, sf_dir),
                   customer=table(spark, sf_dir, "customer"))


@register("sql_avg_balance_by_city", """
SELECT c.c_nationkey AS city_id,
       CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(c.c_acctbal)
         AS avg_balance
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE CAST(o.o_orderdate AS DATE) = DATE '1998-03-01'
GROUP BY c.c_nationkey
""")
def sql_avg_balance_by_city(spark, sf_dir):
    """Average balance per city on one day, as SQL text over registered temp views."""
    v = temp_views({"orders": table(spark, sf_dir, "orders"),
                    "customer": table(spark, sf_dir, "customer")})
    text = f"""
    WITH per_customer AS (         -- one weighted row per customer before the join
      SELECT o_custkey, COUNT(*) AS n FROM {v['orders']}
      WHERE o_orderdate >= CAST(:day AS TIMESTAMP_NTZ)
        AND o_orderdate < CAST(:day AS TIMESTAMP_NTZ) + INTERVAL 1 DAY
      GROUP BY o_custkey)
    SELECT c.c_nationkey AS city_id,
           CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2)) * p.n) AS DOUBLE)
             / SUM(CASE WHEN c.c_acctbal IS NOT NULL THEN p.n END) AS avg_balance
    FROM per_customer p JOIN {v['customer']} c ON p.o_custkey = c.c_custkey
    GROUP BY c.c_nationkey
    ORDER BY avg_balance DESC
    """
    try:
        return run_sql(spark, text, {"day": BALANCE_DAY.isoformat()})
    finally:   # the returned plan is already analysed: the names are no longer needed
        for name in v.values():
            spark.catalog.dropTempView(name)
