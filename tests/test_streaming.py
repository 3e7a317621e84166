import datetime as dt
import decimal

from dayflow.streaming import file_stream, run_complete_to_table, stream_daily_flow
from dayflow.streaming.daily_flow import latest

SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp_ntz")


def test_stream_totals_update_across_arrivals(spark, tmp_path):
    src, table, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    day = dt.datetime(2014, 8, 1)
    first = spark.createDataFrame([(1, 1, "O", 10.5, day), (2, 2, "F", 3.0, day)], SCHEMA)
    first.write.parquet(src + "/a")
    stream = file_stream(spark, src, first.schema, recursive=True)
    run_complete_to_table(stream_daily_flow(stream), table, ckpt)
    r = latest(spark, table).first()
    assert (r["total_purchase_amt"], r["total_redeem_amt"]) == \
        (decimal.Decimal("10.50"), decimal.Decimal("3.00"))
    # a second file arrives; the restarted query resumes from its checkpoint
    spark.createDataFrame([(3, 1, "P", 1.25, day)], SCHEMA).write.parquet(src + "/b")
    run_complete_to_table(stream_daily_flow(stream), table, ckpt)
    r = latest(spark, table).first()
    assert r["total_purchase_amt"] == decimal.Decimal("11.75")
    # the first epoch's folder stays readable
    assert spark.read.parquet(table + "/epoch=0").first()["total_purchase_amt"] == \
        decimal.Decimal("10.50")
