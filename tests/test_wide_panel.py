"""The wide panel's money sums: amounts as cents, every line read once."""

import datetime as dt
import random

from pyspark.sql import functions as F

from dayflow.functions.clean import MONEY_SUM, cents, cents_sum, money, money_sum, to_day
from dayflow.operators.flows import exact_avg
from dayflow.plans import inputs
from dayflow.plans import model_queries as q

ODD = [None, 0.0, -0.0, 0.01, -0.01, 0.29, 1.005, 2.675, -1.005, 0.004999, 0.005, 0.015, 5e-324,
       1.1, 33.33, 1e12 - 0.01, 1e12, 1e12 + 0.01, 123456789012.345, 9007199254740993.0,
       9999999999999998.0, -9999999999999998.0, 90071992547409.92, 1e-7, 1 / 3, -2 / 3]


def test_cents_are_the_cast_amounts(spark):
    rng = random.Random(5)
    values = ODD + [round(rng.uniform(-10 ** k, 10 ** k), d)
                    for k in range(1, 15) for d in (0, 1, 2, 2, 2, 3, 6) for _ in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for column in (df, df.select(F.col("x").cast("decimal(38,4)").alias("x")),
                   df.select(F.col("x").cast("string").alias("x"))):
        both = column.select(cents(column, "x").alias("c"), (money("x") * 100).alias("m"))
        assert both.filter(~F.col("c").eqNullSafe(F.col("m"))).collect() == []
        assert both.filter("c is null").count() == 1
    sums = df.withColumn("c", cents(df, "x")).agg(cents_sum("c").alias("s"), money_sum("x").alias("w"))
    assert sums.filter("s = w").count() == 1 and sums.schema["s"].dataType == sums.schema["w"].dataType
    # more than a bigint of cents, and no amount at all
    big = spark.range(100_000).select(F.lit(9_999_999_999_999_998.0).alias("x"))
    for sign in (1, -1):
        signed = big.select((F.col("x") * sign).alias("x"))
        signed = signed.withColumn("c", cents(signed, "x"))
        assert signed.agg((cents_sum("c") == money_sum("x")).alias("s")).first()[0]
    assert df.filter("x is null").select(cents(df, "x").alias("c")).agg(cents_sum("c")).first()[0] is None


def _tables(spark, root):
    rng = random.Random(3)
    day = lambda i: dt.datetime(2001, 3, 1, 7) + dt.timedelta(days=i)
    amount = lambda: rng.choice([None, *ODD[3:17], *[round(rng.uniform(1, 1e5), 2)] * 20])
    some = lambda *v: rng.choice([None, *v, *v])
    orders = [(amount(), some(*[day(i) for i in range(0, 40) if i != 9]), some("O", "F", "P"),
               some("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
              for _ in range(400)]
    lines = [(amount(), amount(), amount(), amount(), some("A", "N", "R"), some("O", "F"),
              some(*[day(i) for i in range(-3, 45) if i != 8])) for _ in range(900)]
    lines.append((None, None, None, None, "A", "F", day(8)))
    spark.createDataFrame(orders, "o_totalprice double, o_orderdate timestamp, o_orderstatus string, "
                          "o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame(lines, "l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp").write.parquet(f"{root}/lineitem.parquet")


def _averages(lines, columns):
    """The business-day averages by decimal casts of every value."""
    return (lines.select(to_day("l_shipdate").alias("report_date"), *set(columns.values()))
            .filter(~F.dayofweek("report_date").isin(1, 7)).groupBy("report_date")
            .agg(*[exact_avg(F.col(c)).alias(out) for out, c in columns.items()]))


def test_wide_panel_reads_each_line_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _tables(spark, root)
    plans = []
    written = q.materialize

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)
    monkeypatch.setattr(q, "materialize", kept)
    panel = {r["report_date"]: r for r in q.wide_panel(spark, root).collect()}
    scans = [line for p in plans for line in p.split("Initial Plan")[-1].splitlines()
             if "FileScan" in line and "l_shipdate" in line]
    assert len(scans) == 1

    o, li = spark.read.parquet(f"{root}/orders.parquet"), spark.read.parquet(f"{root}/lineitem.parquet")
    total = lambda cond, c: F.sum(F.when(cond, money(c)).otherwise(0)).cast(MONEY_SUM)
    orders = {r["d"]: r for r in o.groupBy(to_day("o_orderdate").alias("d")).agg(
        total(F.col("o_orderstatus").isin("O", "P"), "o_totalprice").alias("purchase"),
        total(F.col("o_orderstatus") == "F", "o_totalprice").alias("redeem"),
        F.count(F.lit(1)).alias("n_orders"),
        *[total(F.col("o_orderpriority").startswith(f"{k}-"), "o_totalprice")
          .alias(f"priority_{k}") for k in (1, 2, 3, 4)]).collect()}
    value = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount",
             "tax": "l_tax"}
    part = {f: F.col("l_returnflag") == f.upper() for f in "anr"} | {"f": F.col("l_linestatus") == "F"}
    lines = {r["d"]: r for r in li.groupBy(to_day("l_shipdate").alias("d")).agg(
        *[total(cond, c).alias(f"{m}_{f}") for f, cond in part.items() for m, c in value.items()]
    ).collect()}
    averages = {r["report_date"]: r for r in _averages(li, q.WIDE_EXOG).collect()}
    assert sorted(panel) == [dt.date(2001, 3, 1) + dt.timedelta(days=i) for i in range(40)]
    last = dict.fromkeys(q.WIDE_EXOG)
    for d in sorted(panel):
        for names, found in ((q.WIDE_ORDERS, orders), (q.WIDE_LINES, lines)):
            for n in names:
                assert panel[d][n] == ((found[d][n] if d in found else None) or 0), (d, n)
        for n in q.WIDE_EXOG:
            if d in averages and averages[d][n] is not None:
                last[n] = averages[d][n]
            assert panel[d][n] == last[n], (d, n)


def test_weekday_series_is_the_exact_average(spark, tmp_path):
    _tables(spark, str(tmp_path))
    li = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    got = inputs.weekday_exog(li, q.WIDE_EXOG)
    want = _averages(li, q.WIDE_EXOG)
    assert got.schema == want.schema
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "floor" in plan.lower()          # amounts by arithmetic, not by their text
