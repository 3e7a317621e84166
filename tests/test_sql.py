import datetime as dt

from dayflow.operators.sql import run_sql, temp_views


def test_run_sql_parameters_and_bindings(spark):
    df = spark.createDataFrame([(1, dt.date(2014, 8, 1), 5), (2, dt.date(2014, 9, 1), 7)],
                               "u int, d date, v int")
    out = run_sql(spark, "SELECT u, v FROM {t} WHERE d >= CAST(:start AS DATE) AND v > :min_v",
                  {"start": "2014-08-15", "min_v": 1}, t=df).collect()
    assert [(r["u"], r["v"]) for r in out] == [(2, 7)]


def test_temp_views_are_unique_per_call(spark):
    df = spark.range(3)
    a = temp_views({"t": df})
    b = temp_views({"t": df})
    assert a["t"] != b["t"]
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {a['t']}").first()["n"] == 3
    for name in (a["t"], b["t"]):
        spark.catalog.dropTempView(name)
