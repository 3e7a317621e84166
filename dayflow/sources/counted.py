"""CSV scan that counts what it could not read, in the same pass.

Rows with too few or too many fields go to a corrupt-record column and are rejected;
fields that fail their pattern take a default.  Both are counted per column by
``observe``, so the counts cost no second scan and belong to exactly the rows written.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "__corrupt"


@dataclass(frozen=True)
class Field:
    """How a text field is read: ``to`` type where it matches ``pattern``, else ``default``."""

    to: str = "string"
    pattern: str | None = None
    default: object = None


def read_csv_counted(spark: SparkSession, path: str, fields: Mapping[str, Field],
                     header: bool = True, sep: str = ",",
                     keep_rejected: bool = False) -> tuple[DataFrame, Observation]:
    """Typed rows and an observation to be read after the frame is written.

    Fields are read by position.  Rejected rows are left out, or kept with their text in
    ``__corrupt`` and defaults elsewhere.  The observation has ``rows_read``,
    ``rows_rejected`` and, per field of the other rows, ``parsed_<name>`` and
    ``defaulted_<name>`` (a null field is defaulted).
    """
    schema = StructType([*[StructField(n, StringType()) for n in fields],
                         StructField(CORRUPT, StringType())])
    raw = (spark.read.option("header", str(header).lower()).option("sep", sep)
           .option("enforceSchema", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path))
    whole = F.col(CORRUPT).isNull()
    value = {}
    for name, f in fields.items():
        ok = F.col(name).isNotNull() if f.pattern is None else F.col(name).rlike(f.pattern)
        value[name] = F.when(whole & ok, F.col(name).try_cast(f.to))
    typed = raw.select(CORRUPT, *[v.alias(n) for n, v in value.items()])
    counted = Observation()
    typed = typed.observe(
        counted, F.count(F.lit(1)).alias("rows_read"), F.count_if(~whole).alias("rows_rejected"),
        *[F.count_if(whole & F.col(n).isNotNull()).alias(f"parsed_{n}") for n in fields],
        *[F.count_if(whole & F.col(n).isNull()).alias(f"defaulted_{n}") for n in fields])
    out = typed if keep_rejected else typed.filter(whole)
    out = out.withColumns({n: F.coalesce(F.col(n), F.lit(f.default).cast(f.to))
                           for n, f in fields.items()})
    return (out if keep_rejected else out.drop(CORRUPT)), counted


def counts_frame(spark: SparkSession, counted: Observation, fields: Mapping[str, Field]) -> DataFrame:
    """One row per field: rows read, parsed, defaulted and rejected."""
    got = counted.get
    rows = [(n, got["rows_read"], got[f"parsed_{n}"], got[f"defaulted_{n}"], got["rows_rejected"])
            for n in fields]
    return spark.createDataFrame(
        rows, "field string, n_read bigint, n_parsed bigint, n_defaulted bigint, n_rejected bigint")
