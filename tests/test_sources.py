import datetime as dt

from dayflow.sources.files import read_csv, string_schema, write_csv


def test_csv_declared_inferred_and_string_reads(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5, dt.date(2014, 9, 1))],
                               "id bigint, s string, x double, d date")
    path = write_csv(df, str(tmp_path / "t"))
    typed = read_csv(spark, path, "id bigint, s string, x double, d date").first()
    assert typed == (1, "a", 2.5, dt.date(2014, 9, 1))
    inferred = read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["x"] == "double"
    raw = read_csv(spark, path, string_schema(["id", "s", "x", "d"])).first()
    assert raw == ("1", "a", "2.5", "2014-09-01")


def test_headerless_single_file_and_modes(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    path = write_csv(df, str(tmp_path / "h"), header=False, single_file=True)
    parts = [p for p in (tmp_path / "h").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    back = read_csv(spark, path, "id bigint, v bigint", header=False)
    assert back.count() == 10
    write_csv(df.limit(3), path, mode="overwrite", header=False)
    assert read_csv(spark, path, "id bigint, v bigint", header=False).count() == 3


def test_partitioned_sink_prunes_on_read(spark, tmp_path):
    from pyspark.sql import functions as F
    from dayflow.sources.files import write_parquet
    days = spark.range(90).select(F.date_add(F.lit("2014-06-01").cast("date"),
                                             F.col("id").cast("int")).alias("d"))
    df = days.withColumn("month", F.date_format("d", "yyyyMM")).withColumn("v", F.lit(1))
    path = write_parquet(df, str(tmp_path / "p"), partition_by=["month"])
    back = spark.read.parquet(path).filter(F.col("month") == 201407)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and back.count() == 31
    csv = write_csv(df, str(tmp_path / "c"), partition_by=["month"])
    assert read_csv(spark, csv, "d date, v int, month int").filter("month = 201407").count() == 31


def test_csv_columns_are_found_by_name(spark, tmp_path):
    import pytest
    (tmp_path / "b.csv").write_text(
        "user_id,report_date,tBalance,yBalance,total_purchase_amt,total_redeem_amt\n"
        "1,20140801,111,222,7,9\n")
    cols = ["user_id", "report_date", "total_purchase_amt", "total_redeem_amt"]
    r = read_csv(spark, str(tmp_path / "b.csv"), string_schema(cols)).first()
    assert tuple(r) == ("1", "20140801", "7", "9")
    r = read_csv(spark, str(tmp_path / "b.csv"), "total_redeem_amt int, user_id bigint").first()
    assert (r["total_redeem_amt"], r["user_id"]) == (9, 1)
    with pytest.raises(ValueError, match="no columns"):
        read_csv(spark, str(tmp_path / "b.csv"), "user_id int, absent int")


def test_stream_over_a_directory_table(spark, tmp_path):
    from conftest import SF0001
    from dayflow.plans.all import QUERIES
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    orders.repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    stream = QUERIES["stream_daily_flow"](spark, str(tmp_path)).collect()
    batch = QUERIES["daily_flow"](spark, SF0001).collect()
    assert len(stream) > 0 and sorted(map(tuple, stream)) == sorted(map(tuple, batch))
