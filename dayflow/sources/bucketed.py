"""Tables bucketed by a join key, written once, joined and grouped without a shuffle.

Both sides of a join, or a fact table and its grouping, that share the key and the number of
buckets are already dealt out alike, so Spark plans no exchange for them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dayflow.session import scratch_path


def write_bucketed(df: DataFrame, by: str, buckets: int, name: str | None = None,
                   path: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` buckets of ``by``, sorted inside each file.

    Rows are gathered by the key before writing, and a key that holds a large share of
    them is split over tasks (a bucket then has several files).  ``path`` defaults to a
    fresh folder below the shared scratch root; ``name`` to a fresh table name.
    """
    spark = df.sparkSession
    name = name or f"dayflow_{uuid.uuid4().hex}"
    (df.hint("rebalance", by).write.format("parquet").mode("errorifexists")
     .option("path", path or scratch_path(spark, "bucketed"))
     .bucketBy(buckets, by).sortBy(by).saveAsTable(name))
    return spark.table(name)


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay in their folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
