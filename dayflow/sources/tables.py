"""Parquet table loading.

Loads are lazy and column-pruned by Catalyst; callers select only the columns
they need so the scan's ReadSchema stays narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet`` (a file or a directory of parts)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
