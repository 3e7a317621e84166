"""SQL text over DataFrames: named parameters and DataFrame bindings.

``spark.sql(text, args, **frames)`` binds ``:name`` parameter markers to
literals (no string formatting of values into SQL) and ``{name}`` references
to DataFrames, so no session-global view name is needed.  ``temp_views``
registers classic temp views for text that refers to fixed table names.
Either way Catalyst sees one plan: filters on parameters are constant-folded
and pushed to the scan like literals written in the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None,
            **frames: DataFrame) -> DataFrame:
    """``spark.sql`` with ``:name`` parameters and ``{name}`` DataFrame bindings."""
    return spark.sql(text, args=dict(args or {}), **frames)


def temp_views(views: Mapping[str, DataFrame], unique: bool = True) -> dict[str, str]:
    """Register temp views; returns logical name -> registered name.

    With ``unique`` each view gets a per-call suffix so concurrent jobs in one
    session cannot replace each other's views.
    """
    out = {}
    for name, df in views.items():
        reg = f"{name}_{uuid.uuid4().hex[:12]}" if unique else name
        df.createOrReplaceTempView(reg)
        out[name] = reg
    return out
