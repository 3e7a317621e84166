"""CSV sources and sinks with declared schemas.

Reading with an explicit ``StructType`` avoids the extra inference pass over
the input (``inferSchema`` reads the data twice).  Writes are distributed; a
single output file is opt-in (``single_file``) because it funnels the write
through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def string_schema(columns: list[str]) -> StructType:
    """All-string schema: the raw form of a header CSV before typing."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, sep: str = ",", infer: bool = False) -> DataFrame:
    """CSV scan.  With ``schema`` no inference pass runs; ``infer`` is a fallback.

    With a header, the columns of ``schema`` are found by name: the file may have
    more columns and another order.  A declared column that the header lacks
    raises.  Without a header they are taken by position.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", str(infer).lower()).csv(path)
    if not header:
        return reader.schema(schema).csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = reader.csv(path).columns            # reads the header line only
    if missing := [f.name for f in schema.fields if f.name not in names]:
        raise ValueError(f"read_csv: no columns {missing} in {path}: {names}")
    declared = {f.name: f for f in schema.fields}
    whole = StructType([declared.get(n, StructField(n, StringType())) for n in names])
    return reader.schema(whole).csv(path).select(*schema.fieldNames())


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True,
              sep: str = ",", single_file: bool = False,
              partition_by: list[str] | None = None) -> str:
    """CSV sink.  ``mode`` as in Spark (default: fail if the path exists).

    ``partition_by`` writes one directory per value (e.g. a month column), so
    later reads filtered on it prune whole directories (PartitionFilters).
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("header", str(header).lower()).option("sep", sep)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> str:
    """Parquet sink for intermediates and results (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
