"""Queries over mergeable, committed, bucketed and incremental forms of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY_SUM, add_amounts, to_day
from dayflow.functions.fmt import yyyymmdd
from dayflow.operators import bitmaps, filters, flows, incremental, panel, time_blocks
from dayflow.plans.flow_queries import DAILY_FLOW_SQL, FLOW_MONTH, USER_FLOW_SQL
from dayflow.plans.inputs import order_flows, table
from dayflow.plans.model_queries import (
    EXTRACT_SQL, HORIZON, KEYS, NATION_PANEL_SQL, TARGETS, _extract, _rollout_ar, nation_panel,
)
from dayflow.plans.registry import register
from dayflow.session import materialize, scratch_path
from dayflow.sources import committed, counted, monthly
from dayflow.sources.bucketed import write_bucketed
from dayflow.sources.counted import Field
from dayflow.sources.files import read_csv, write_csv

BUCKETS = 8


# --- one long series on many tasks ----------------------------------------------
@register("forward_fill_blocks", """
SELECT o_orderkey, LAST_VALUE(price IGNORE NULLS) OVER (
  ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_price
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS price
      FROM orders) o
""")
def forward_fill_blocks(spark, sf_dir):
    """Price of the last order of status P, over all orders as one series."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(
        F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("last_price"))
    return time_blocks.blocked_forward_fill(o, [], "o_orderkey", ["last_price"])


@register("lag_blocks", f"""
SELECT o_orderkey, {", ".join(f'FIRST(o_totalprice) OVER (ORDER BY o_orderkey RANGE BETWEEN '
                              f'{i} PRECEDING AND {i} PRECEDING) AS price_{i}' for i in range(1, 15))}
FROM orders
""")
def lag_blocks(spark, sf_dir):
    """Prices of the orders 1 to 14 keys before, over all orders as one series."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return time_blocks.blocked_lag_features(o, [], "o_orderkey", ["price"]).drop("price")


# --- exact distinct counts from mergeable state -----------------------------------
def _event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", to_day("ts").alias("day"))


@register("active_days_masks", """
SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days FROM events GROUP BY user_id
""")
def active_days_masks(spark, sf_dir):
    """Distinct active days of every user from stored monthly masks."""
    state = materialize(bitmaps.day_masks(_event_days(spark, sf_dir), "user_id", "day"), "masks")
    return bitmaps.distinct_days(state, "user_id")


@register("active_users_bitmaps", """
SELECT CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month, COUNT(DISTINCT user_id) AS n_users
FROM events GROUP BY 1
UNION ALL SELECT CAST(0 AS INTEGER), COUNT(DISTINCT user_id) FROM events
""")
def active_users_bitmaps(spark, sf_dir):
    """Distinct users a month, and of all months (month 0), from stored bitmaps."""
    ev = _event_days(spark, sf_dir).withColumn("month", bitmaps.month_of(F.col("day")))
    state = materialize(bitmaps.entity_bitmaps(ev, "user_id", ["month"]), "bitmaps")
    whole = bitmaps.distinct_entities(state, out="n_users").select(F.lit(0).alias("month"), "n_users")
    return bitmaps.distinct_entities(state, ["month"], "n_users").unionByName(whole)


# --- committed output ---------------------------------------------------------------
@register("sink_committed", DAILY_FLOW_SQL)
def sink_committed(spark, sf_dir):
    """Daily totals published over an earlier version, beside a writer that ended midway."""
    root = scratch_path(spark, "committed")
    flow = flows.daily_totals(order_flows(table(spark, sf_dir, "orders")), "report_date",
                              {"total_purchase_amt": "purchase", "total_redeem_amt": "redeem"})
    flow = materialize(flow, "daily-flow")
    committed.commit(flow.filter("total_redeem_amt > 0"), root)
    committed.commit(flow, root, mode="overwrite", spec="daily flow")
    flow.filter("total_redeem_amt = 0").write.parquet(committed.new_version(root))  # never published
    return committed.read_committed(spark, root, spec="daily flow")


@register("sink_single_file", EXTRACT_SQL.replace("SELECT c_nationkey,", "SELECT 1::BIGINT AS n_files, c_nationkey,", 1))
def sink_single_file(spark, sf_dir):
    """The horizon extract as one headerless CSV part file, read back; with the number of part
    files (bounded: series x horizon rows)."""
    path = scratch_path(spark, "submission-file")
    write_csv(_extract(spark, sf_dir), path, header=False, single_file=True)
    back = read_csv(spark, path, "c_nationkey int, report_date string, purchase bigint, "
                                 "redeem bigint", header=False)
    n = len(committed.files_of(spark, path))
    return back.select(F.lit(n).cast("bigint").alias("n_files"), "*")


# --- partial rewrite of the filled matrix -----------------------------------------
@register("matrix_partial_rewrite", f"""
WITH np AS ({NATION_PANEL_SQL}),
e AS (SELECT MAX(report_date) AS last FROM np),
d AS (
  SELECT c_nationkey, report_date, FALSE AS ahead FROM np
  UNION ALL
  SELECT n.c_nationkey, CAST(g.d AS DATE), TRUE FROM (SELECT DISTINCT c_nationkey FROM np) n
  CROSS JOIN (SELECT unnest(generate_series(last + INTERVAL 1 DAY,
                                            last + INTERVAL {HORIZON} DAY, INTERVAL 1 DAY)) AS d
              FROM e) g)
SELECT CAST(year(report_date) * 100 + month(report_date) AS INTEGER) AS month,
  COUNT(*) AS n_rows, COUNT(*) FILTER (ahead) AS n_forecasts, BOOL_OR(ahead) AS rewritten
FROM d GROUP BY 1
""")
def matrix_partial_rewrite(spark, sf_dir):
    """Forecasts written into the monthly filled matrix: rows and forecasts a month, and
    whether its files are others than before."""
    p = materialize(nation_panel(spark, sf_dir), "nation-panel")
    path = scratch_path(spark, "matrix")
    cells = [F.col(t).cast("double").alias(t) for t in TARGETS]
    monthly.write_monthly(panel.horizon_union(p, KEYS, "report_date", HORIZON).select(
        *KEYS, "report_date", *cells, F.lit(False).alias("forecast")), path, "report_date")
    named = lambda: monthly.read_monthly(spark, path).select(
        "month", F.input_file_name().alias("file")).distinct()
    before = materialize(named(), "files-before")
    fc = _rollout_ar(spark, sf_dir, p).groupBy(*KEYS, "report_date").agg(*[
        F.max(F.when(F.col("target") == t, F.col("forecast"))).alias(t) for t in TARGETS])
    monthly.upsert_monthly(spark, path, fc.withColumn("forecast", F.lit(True)),
                           [*KEYS, "report_date"], [*TARGETS, "forecast"], "report_date")
    kept = named().join(before, ["month", "file"]).select("month").distinct()
    rows = monthly.read_monthly(spark, path).groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("forecast").alias("n_forecasts"))
    return rows.join(kept.withColumn("kept", F.lit(True)), "month", "left").select(
        "month", "n_rows", "n_forecasts", F.col("kept").isNull().alias("rewritten"))


# --- bad rows counted in the pass that reads them ---------------------------------
COUNTED = {"user_id": Field("bigint", r"^\d+$"), "city": Field("int", r"^1?\d$", -1),
           "balance": Field("decimal(18,2)", r"^\d+(\.\d+)?$", 0), "segment": Field()}


@register("src_csv_counted", """
WITH c AS (SELECT *, c_custkey % 7 = 0 OR c_custkey % 11 = 0 AS bad FROM customer),
n AS (
  SELECT COUNT(*) AS n_read, COUNT(*) FILTER (bad) AS n_rejected,
    COUNT(*) FILTER (NOT bad) AS whole,
    COUNT(*) FILTER (NOT bad AND c_nationkey < 20) AS cities,
    COUNT(*) FILTER (NOT bad AND c_acctbal >= 0) AS balances FROM c),
f AS (
  SELECT 'user_id' AS field, whole AS n_parsed FROM n UNION ALL SELECT 'city', cities FROM n
  UNION ALL SELECT 'balance', balances FROM n UNION ALL SELECT 'segment', whole FROM n)
SELECT field, n_read, n_parsed, whole - n_parsed AS n_defaulted, n_rejected FROM f, n
""")
def src_csv_counted(spark, sf_dir):
    """Customers as CSV lines, some cut short (key divisible by 7) or too long (by 11), with
    values outside the fields' patterns: rows read, parsed, defaulted and rejected a field."""
    path = scratch_path(spark, "customers-csv")
    key = F.col("c_custkey")
    line = F.concat_ws(",", key.cast("string"), F.col("c_nationkey").cast("string"),
                       F.col("c_acctbal").cast("decimal(18,2)").cast("string"), "c_mktsegment")
    table(spark, sf_dir, "customer").select(
        F.when(key % 7 == 0, F.concat_ws(",", key.cast("string"), F.lit("cut")))
        .when(key % 11 == 0, F.concat_ws(",", line, F.lit("more"))).otherwise(line).alias("value")
    ).write.text(path)
    rows, seen = counted.read_csv_counted(spark, path, COUNTED, header=False)
    materialize(rows, "customers-typed")
    return counted.counts_frame(spark, seen, COUNTED)


# --- joins without a fact shuffle --------------------------------------------------
def bucketed_inputs(spark, sf_dir, buckets=BUCKETS):
    """Order flows and customers, bucketed by user."""
    facts = order_flows(table(spark, sf_dir, "orders")).drop("report_date")
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"),
                                                    F.col("c_nationkey").alias("city_id"))
    return write_bucketed(facts, "user_id", buckets), write_bucketed(users, "user_id", buckets)


def bucketed_flow(facts, users):
    month = filters.month_filter(facts, "o_orderdate", FLOW_MONTH)
    return flows.flow_by_entity(month, "user_id", add_amounts("purchase", "redeem"), users,
                                "user_id", ["city_id"]).select("city_id", "user_id", "total_flow")


@register("user_month_flow_bucketed", USER_FLOW_SQL)
def user_month_flow_bucketed(spark, sf_dir):
    """``user_month_flow`` over tables bucketed by user: no exchange on either side."""
    return bucketed_flow(*bucketed_inputs(spark, sf_dir))


# --- new days only ------------------------------------------------------------------
LATE_DAYS = 20          # the last days arrive as a second batch, with late rows before them
DAY_LAGS = (1, 2, 7, 14)


@register("daily_flow_incremental", f"""
WITH d AS ({DAILY_FLOW_SQL})
SELECT strftime(d.report_date, '%Y%m%d') AS report_date, d.total_purchase_amt,
  {", ".join(f"l{i}.total_purchase_amt AS total_purchase_amt_{i}" for i in DAY_LAGS)}
FROM d {" ".join(f"LEFT JOIN d l{i} ON l{i}.report_date = d.report_date - {i}" for i in DAY_LAGS)}
""")
def daily_flow_incremental(spark, sf_dir):
    """Daily totals and their lags after a second batch of days and late rows: only touched
    months are read and rewritten, the result is that of a full rebuild."""
    o = order_flows(table(spark, sf_dir, "orders"), keep=("o_orderkey",))
    last = o.select(F.max("report_date")).first()[0]
    # late rows: those of one key in 97, of the 60 days before the batch
    age = F.datediff(F.lit(last), F.col("report_date"))
    second = (age < LATE_DAYS) | ((age < LATE_DAYS + 60) & (F.col("o_orderkey") % 97 == 0))
    root = scratch_path(spark, "incremental")
    measures = {"total_purchase_amt": "purchase"}
    for batch in (o.filter(~second), o.filter(second)):
        days = incremental.add_facts(spark, f"{root}/totals", batch, "report_date", measures)
        incremental.refresh_lags(spark, f"{root}/totals", f"{root}/lags", "report_date",
                                 list(measures), days, lags=DAY_LAGS)
    out = spark.read.parquet(f"{root}/lags")
    names = [c for c in out.columns if c not in ("report_date", "month")]
    return out.select(yyyymmdd("report_date").alias("report_date"),
                      *[F.col(c).cast(MONEY_SUM).alias(c) for c in names])
