"""Role mapping from the driver tables to the reference's data model.

* user / city            : customer.c_custkey / customer.c_nationkey
* purchase / redeem      : orders.o_totalprice when o_orderstatus in ('O','P') / = 'F'
* balance                : customer.c_acctbal
* dense keyed panel      : events (user_id, day): sum(value), count
* long series / panel    : orders totals per (c_nationkey, day)
* sparse exogenous series: lineitem avg(l_discount), avg(l_tax) per ship day, weekdays only

Each helper selects only the columns it needs, so the Parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY, MONEY_SUM, cents, cents_sum, money, to_day
from dayflow.sources.tables import load

PURCHASE_STATUS = ("O", "P")
REDEEM_STATUS = "F"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


def order_flows(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """orders -> (user_id, report_date, purchase, redeem, o_orderdate) with exact amounts."""
    price = money("o_totalprice")
    zero = F.lit(0).cast(MONEY)
    return orders.select(
        *keep,
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate"),
        to_day("o_orderdate").alias("report_date"),
        F.when(F.col("o_orderstatus").isin(*PURCHASE_STATUS), price).otherwise(zero)
         .alias("purchase"),
        F.when(F.col("o_orderstatus") == REDEEM_STATUS, price).otherwise(zero)
         .alias("redeem"),
    )


def event_days(events: DataFrame) -> DataFrame:
    """events -> (user_id, report_date, value) with exact amounts."""
    return events.select("user_id", to_day("ts").alias("report_date"),
                         money("value").alias("value"))


def event_panel_days(events: DataFrame) -> DataFrame:
    """Per (user_id, report_date): exact value sum and event count."""
    return (event_days(events).groupBy("user_id", "report_date")
            .agg(F.sum("value").cast(MONEY_SUM).alias("value_sum"),
                 F.count(F.lit(1)).alias("n_events")))


def nation_daily(orders: DataFrame, customer: DataFrame,
                 pre_aggregate: bool = False) -> DataFrame:
    """Per (c_nationkey, report_date): exact purchase and redeem totals.

    Default: join first, then aggregate.  The fact rows cross the network once
    (hash-partitioned on the customer key for a sort-merge join, or not at all
    when AQE broadcasts a small customer table); a customer holding a large
    share of the orders is split across tasks by AQE's skew-join handling, and
    the (nation, day) sums are partially aggregated before their own small
    shuffle.  ``pre_aggregate`` first sums per (customer, day): worth it only
    when facts have many rows per customer and day (event-level data), since
    that aggregate's (customer, day) partitioning costs a second fact-sized
    shuffle for the join.
    """
    fl = order_flows(orders)
    if pre_aggregate:
        fl = (fl.groupBy("user_id", "report_date")
              .agg(F.sum("purchase").alias("purchase"), F.sum("redeem").alias("redeem")))
    cust = customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    return (fl.join(cust, "user_id", "inner")
              .groupBy("c_nationkey", "report_date")
              .agg(F.sum("purchase").cast(MONEY_SUM).alias("purchase"),
                   F.sum("redeem").cast(MONEY_SUM).alias("redeem")))


def weekday_exog(lineitem: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exogenous business-day series: exact daily averages (out name -> column),
    Mon-Fri only, all computed in one scan and one aggregate."""
    d = to_day("l_shipdate")
    return (lineitem.select(d.alias("report_date"),
                            *[cents(lineitem, c).alias(c) for c in set(columns.values())])
            .filter(~F.dayofweek("report_date").isin(1, 7))
            .groupBy("report_date")
            .agg(*[F.when(F.count(c) > 0, cents_sum(c).cast("double") / F.count(c)).alias(out)
                   for out, c in columns.items()]))
