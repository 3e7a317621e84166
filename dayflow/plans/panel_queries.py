"""Panel queries: wide daily panel, segment counts, sentinel join, spines,
horizon placeholders, forward fill and exogenous joins (the reference's
feature-panel assembly)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY_SUM, money, to_day
from dayflow.operators import panel
from dayflow.plans.inputs import event_panel_days, nation_daily, table, weekday_exog
from dayflow.plans.registry import register
from dayflow.session import materialize

HORIZON = 30          # forecast window after the last observed day
FILL_HORIZON = 7      # spine end for the forward-fill panel (last day + 7)
RATIO_DEFAULT = 3.0   # fixed value: the reference's ratio when the denominator is 0
SEGMENTS = {"n_automobile": "AUTOMOBILE", "n_building": "BUILDING"}
UNKNOWN_SEGMENT = "UNKNOWN"
LABEL_SENTINEL = 2    # fixed value: the reference's sentinel for a missing 0/1 attribute

# --- oracle fragments -------------------------------------------------------
EVENT_DAYS_SQL = """
SELECT user_id, CAST(ts AS DATE) AS report_date,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_sum,
       COUNT(*) AS n_events
FROM events GROUP BY user_id, CAST(ts AS DATE)
"""


def spine_sql(extra_days: int) -> str:
    return f"""
SELECT u.user_id, CAST(g.d AS DATE) AS report_date
FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT unnest(generate_series(
    (SELECT MIN(CAST(ts AS DATE)) FROM events),
    (SELECT MAX(CAST(ts AS DATE)) FROM events) + INTERVAL {extra_days} DAY,
    INTERVAL 1 DAY)) AS d) g
"""


SEGMENT_SQL = """
SELECT CAST(o.o_orderdate AS DATE) AS report_date,
  CAST(SUM(CASE WHEN COALESCE(c.c_mktsegment, 'UNKNOWN') = 'AUTOMOBILE' THEN 1 ELSE 0 END)
       AS BIGINT) AS n_automobile,
  CAST(SUM(CASE WHEN COALESCE(c.c_mktsegment, 'UNKNOWN') = 'BUILDING' THEN 1 ELSE 0 END)
       AS BIGINT) AS n_building
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY CAST(o.o_orderdate AS DATE)
"""

NATION_DAILY_SQL = """
SELECT c.c_nationkey, CAST(o.o_orderdate AS DATE) AS report_date,
  CAST(SUM(CASE WHEN o_orderstatus IN ('O','P') THEN CAST(o_totalprice AS DECIMAL(18,2))
           ELSE 0 END) AS DECIMAL(38,2)) AS purchase,
  CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2))
           ELSE 0 END) AS DECIMAL(38,2)) AS redeem
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey, CAST(o.o_orderdate AS DATE)
"""


def exog_sql(column: str, out: str) -> str:
    return f"""
SELECT CAST(l_shipdate AS DATE) AS report_date,
       CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({column}) AS {out}
FROM lineitem WHERE dayofweek(l_shipdate) NOT IN (0, 6)
GROUP BY CAST(l_shipdate AS DATE)
"""


EXOG_COLUMNS = {"avg_discount": "l_discount", "avg_tax": "l_tax"}


def _event_days(spark, sf_dir):
    """The (user, day) aggregate, written once: the panels read it for its keys, its
    day range and its rows, the events only here."""
    return materialize(event_panel_days(table(spark, sf_dir, "events")), "event-days")


def _event_spine(spark, sf_dir, extra_days):
    days = _event_days(spark, sf_dir)
    rng = panel.day_range(days, "report_date", 0, extra_days)
    return days, panel.panel_spine(days, ["user_id"], rng)


@register("daily_panel", """
SELECT CAST(l_shipdate AS DATE) AS report_date,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_price,
       CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_discount,
       CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_tax,
       COUNT(*) AS n_lines
FROM lineitem GROUP BY CAST(l_shipdate AS DATE)
""")
def daily_panel(spark, sf_dir):
    """Wide multi-measure daily sums (one partial + final hash aggregate)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.select(to_day("l_shipdate").alias("report_date"), "l_quantity",
                      "l_extendedprice", "l_discount", "l_tax")
              .groupBy("report_date")
              .agg(F.sum(money("l_quantity")).cast(MONEY_SUM).alias("sum_qty"),
                   F.sum(money("l_extendedprice")).cast(MONEY_SUM).alias("sum_price"),
                   F.sum(money("l_discount")).cast(MONEY_SUM).alias("sum_discount"),
                   F.sum(money("l_tax")).cast(MONEY_SUM).alias("sum_tax"),
                   F.count(F.lit(1)).alias("n_lines")))


def _segment_counts(spark, sf_dir):
    # join first (orders cross the network once; AQE splits a hot customer's
    # partition), then count per day with a partial aggregate before the small
    # day shuffle.  Pre-counting per (customer, day) would add a second
    # fact-sized shuffle, since orders are about one per customer and day.
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), to_day("o_orderdate").alias("report_date"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = panel.left_join_sentinel(o, cust, "c_custkey",
                                      {"c_mktsegment": UNKNOWN_SEGMENT})
    return panel.segment_counts(joined, ["report_date"], "c_mktsegment", SEGMENTS)


@register("segment_counts", SEGMENT_SQL)
def segment_counts(spark, sf_dir):
    """Per day: orders of two customer segments (missing customers -> sentinel)."""
    return _segment_counts(spark, sf_dir)


@register("segment_ratio", f"""
SELECT report_date, n_automobile, n_building,
       CASE WHEN n_building <> 0 THEN CAST(n_automobile AS DOUBLE) / n_building
            ELSE 3.0 END AS segment_ratio
FROM ({SEGMENT_SQL}) s
""")
def segment_ratio(spark, sf_dir):
    """Per day: segment ratio, 3.0 when the denominator is 0."""
    s = _segment_counts(spark, sf_dir)
    return s.withColumn("segment_ratio", panel.guarded_ratio(
        F.col("n_automobile"), F.col("n_building"), RATIO_DEFAULT))


@register("left_join_sentinel", """
SELECT d.doc_id, d.lang, d.source, COALESCE(l.quality, 2) AS quality,
       COALESCE(l.toxic, 2) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def left_join_sentinel(spark, sf_dir):
    """Documents LEFT JOIN labels; unlabelled documents get sentinel 2 (text not read)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return panel.left_join_sentinel(docs, labels, "doc_id",
                                    {"quality": LABEL_SENTINEL, "toxic": LABEL_SENTINEL})


@register("fillna_measures", f"""
SELECT s.user_id, s.report_date, COALESCE(d.value_sum, 0) AS value_sum,
       COALESCE(d.n_events, 0) AS n_events
FROM ({spine_sql(0)}) s LEFT JOIN ({EVENT_DAYS_SQL}) d
  ON s.user_id = d.user_id AND s.report_date = d.report_date
""")
def fillna_measures(spark, sf_dir):
    """Dense (user, day) panel; days without events get 0 measures."""
    days = _event_days(spark, sf_dir)
    return panel.dense_panel(days, ["user_id"], "report_date",
                             panel.day_range(days, "report_date"),
                             {"value_sum": 0, "n_events": 0})


@register("date_spine", f"""
SELECT DISTINCT report_date FROM ({spine_sql(HORIZON)}) s
""")
def date_spine(spark, sf_dir):
    """One row per day from the first event day to the last + 30."""
    days = _event_days(spark, sf_dir)
    return panel.date_spine(spark, panel.day_range(days, "report_date", 0, HORIZON))


@register("panel_spine", spine_sql(HORIZON))
def panel_spine(spark, sf_dir):
    """Every (user, day) of the event range extended by the 30-day horizon."""
    return _event_spine(spark, sf_dir, HORIZON)[1]


HORIZON_UNION_SQL = f"""
SELECT user_id, report_date, value_sum, n_events FROM ({EVENT_DAYS_SQL}) h
UNION ALL
SELECT u.user_id, CAST(g.d AS DATE) AS report_date,
       CAST(NULL AS DECIMAL(38,2)) AS value_sum, CAST(NULL AS BIGINT) AS n_events
FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT unnest(generate_series(
    (SELECT MAX(CAST(ts AS DATE)) FROM events) + INTERVAL 1 DAY,
    (SELECT MAX(CAST(ts AS DATE)) FROM events) + INTERVAL {HORIZON} DAY,
    INTERVAL 1 DAY)) AS d) g
"""


@register("horizon_union", HORIZON_UNION_SQL)
def horizon_union(spark, sf_dir):
    """Observed (user, day) rows UNION ALL null placeholders for the next 30 days."""
    return panel.horizon_union(_event_days(spark, sf_dir), ["user_id"], "report_date",
                               HORIZON)


@register("forward_fill", f"""
SELECT s.user_id, s.report_date,
  LAST_VALUE(d.value_sum IGNORE NULLS) OVER w AS value_sum,
  LAST_VALUE(d.n_events IGNORE NULLS) OVER w AS n_events
FROM ({spine_sql(FILL_HORIZON)}) s LEFT JOIN ({EVENT_DAYS_SQL}) d
  ON s.user_id = d.user_id AND s.report_date = d.report_date
WINDOW w AS (PARTITION BY s.user_id ORDER BY s.report_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def forward_fill(spark, sf_dir):
    """Per user: last observed value carried forward over the (user, day) spine."""
    days = _event_days(spark, sf_dir)
    p = panel.dense_panel(days, ["user_id"], "report_date",
                          panel.day_range(days, "report_date", 0, FILL_HORIZON))
    return panel.forward_fill(p, ["user_id"], "report_date", ["value_sum", "n_events"])


@register("exog_join_ffill", f"""
SELECT p.c_nationkey, p.report_date, p.purchase, p.redeem,
  LAST_VALUE(x1.avg_discount IGNORE NULLS) OVER w AS avg_discount,
  LAST_VALUE(x2.avg_tax IGNORE NULLS) OVER w AS avg_tax
FROM ({NATION_DAILY_SQL}) p
LEFT JOIN ({exog_sql('l_discount', 'avg_discount')}) x1 ON p.report_date = x1.report_date
LEFT JOIN ({exog_sql('l_tax', 'avg_tax')}) x2 ON p.report_date = x2.report_date
WINDOW w AS (PARTITION BY p.c_nationkey ORDER BY p.report_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def exog_join_ffill(spark, sf_dir):
    """(nation, day) panel + two business-day series, forward filled per nation."""
    p = nation_daily(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    li = table(spark, sf_dir, "lineitem")
    # both series come from lineitem: one scan, one aggregate, one broadcast join
    joined = panel.join_daily_series(p, [weekday_exog(li, EXOG_COLUMNS)], "report_date")
    return panel.forward_fill(joined, ["c_nationkey"], "report_date",
                              ["avg_discount", "avg_tax"])
