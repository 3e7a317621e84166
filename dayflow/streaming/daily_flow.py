"""Incremental daily purchase / redeem totals over a stream of order files.

* Source: ``readStream`` over a directory of Parquet files with a declared
  schema (streaming sources never infer), optionally filtered by file name.
* Operator: :func:`dayflow.operators.flows.daily_totals`, the batch operator,
  applied to the streaming frame; Spark keeps one aggregation state row per
  day (bounded by the calendar), checkpointed for restarts.
* Sink: complete-mode result written with ``foreachBatch`` to a folder of its own
  per epoch, so replaying an epoch after a failure rewrites that folder only and
  earlier results stay readable.  ``availableNow`` processes what is there and
  stops; :func:`latest` reads the newest epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.operators.flows import daily_totals
from dayflow.plans.inputs import order_flows


def file_stream(spark: SparkSession, directory: str, schema, name_glob: str | None = None,
                max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """Streaming Parquet source over ``directory`` (declared schema)."""
    r = spark.readStream.schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(directory)


def run_complete_to_table(agg: DataFrame, table_path: str, checkpoint: str,
                          available_now: bool = True):
    """Run a streaming aggregate; each micro-batch writes ``table_path/epoch=n``."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/epoch={epoch}")

    w = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def latest(spark: SparkSession, table_path: str) -> DataFrame:
    """The result of the newest epoch."""
    every = spark.read.parquet(table_path)
    newest = every.select(F.max("epoch")).first()[0]
    return every.filter(F.col("epoch") == newest).drop("epoch")


def table_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Streaming source over a Parquet table: a directory of parts or one file."""
    table = spark.read.parquet(path)
    files = table.inputFiles()
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if len(files) == 1 and files[0].rsplit("/", 1)[-1] == name:
        return file_stream(spark, path.rstrip("/").rsplit("/", 1)[0], table.schema, name, **options)
    return file_stream(spark, path, table.schema, **options)


def stream_daily_flow(orders_stream: DataFrame) -> DataFrame:
    """Streaming daily totals (same columns as the batch ``daily_flow``)."""
    return daily_totals(order_flows(orders_stream), "report_date",
                        {"total_purchase_amt": "purchase", "total_redeem_amt": "redeem"})
