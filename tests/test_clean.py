import datetime as dt
import decimal

from pyspark.sql import functions as F

from dayflow.functions.clean import DECIMAL_AMOUNT, add_amounts, parse_amount, parse_yyyymmdd
from dayflow.functions.fmt import format_amount, yyyymmdd


def test_parse_amount_digits_rule(spark):
    raw = ["123", "", "abc", "-5", "1.5", "99999999999", None, "007"]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r[0] for r in df.select(parse_amount("s").alias("v")).collect()]
    # digits parse (also beyond the int range, kept as bigint); all else -> 0
    assert got == [123, 0, 0, 0, 0, 99999999999, 0, 7]


def test_parse_amount_decimal_rule(spark):
    raw = ["-5", "1.50", "1.0E7", "x1", None]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r[0] for r in df.select(
        parse_amount("s", DECIMAL_AMOUNT, "decimal(18,2)", None).alias("v")).collect()]
    assert got == [decimal.Decimal("-5.00"), decimal.Decimal("1.50"),
                   decimal.Decimal("10000000.00"), None, None]


def test_parse_yyyymmdd_int_and_bad_text(spark):
    df = spark.createDataFrame([(20140831, "20140901"), (20140230, "2014-09-01")],
                               "i int, s string")
    got = df.select(parse_yyyymmdd("i").alias("a"), parse_yyyymmdd("s").alias("b")).collect()
    assert got[0] == (dt.date(2014, 8, 31), dt.date(2014, 9, 1))
    assert got[1] == (None, None)


def test_format_and_render(spark):
    df = spark.createDataFrame([(decimal.Decimal("1234567.50"), dt.date(2014, 9, 1))],
                               "x decimal(38,2), d date")
    r = df.select(format_amount("x", 2).alias("a"), yyyymmdd("d").alias("s"),
                  yyyymmdd("d", as_long=True).alias("n")).first()
    assert r == ("1,234,567.50", "20140901", 20140901)


def test_add_amounts_null_semantics(spark):
    # string amounts are parsed first (ANSI would reject string arithmetic)
    df = spark.createDataFrame([("5", "7"), ("5", None), ("x", "2")], "a string, b string")
    a, b = parse_amount("a", default=None), parse_amount("b", default=None)
    rows = df.select(add_amounts(a, b).alias("s"),
                     add_amounts(a, b, coalesce_nulls=True).alias("c")).collect()
    assert [(r["s"], r["c"]) for r in rows] == [(12, 12), (None, 5), (None, 2)]
    total = df.select(add_amounts(a, b).alias("s")).agg(F.sum("s")).first()[0]
    assert total == 12          # SUM skips the null rows


def test_parse_amount_out_of_range_takes_default(spark):
    df = spark.createDataFrame([("99999999999999999999",), ("3000000000",)], "s string")
    got = [tuple(r) for r in df.select(parse_amount("s").alias("b"),
                                       parse_amount("s", to="int").alias("i")).collect()]
    assert got == [(0, 0), (3000000000, 0)]
