"""Model-set persistence: one saved ``LinearRegressionModel`` per target.

A set is written aside, models and a Parquet table of coefficients ``(target, term, value)``,
and published with one manifest (:mod:`dayflow.sources.committed`): a set of which
only some models were written does not load, and the one before it still does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from dayflow.sources import committed

COEFFICIENTS = "coefficients"


def model_path(root: str, target: str) -> str:
    # Fixed value: the directory name of the reference's saved models.
    return f"{root.rstrip('/')}/linear_regression_model_{target}"


def save_models(models: Mapping[str, object], root: str, overwrite: bool = True,
                terms: Sequence[str] | None = None) -> str:
    """Save and publish a set of models (independent writes, run concurrently).

    ``terms`` names the features in the coefficient table (by number without it).
    """
    spark = SparkSession.active()
    if not overwrite and committed.manifest(spark, root):
        raise FileExistsError(f"{root} has a published model set")
    path = committed.new_version(root)
    rows = []
    for t, m in models.items():
        values = m.coefficients.toArray()
        names = terms or [f"feature_{i}" for i in range(len(values))]
        rows.append((t, "intercept", float(m.intercept)))
        rows += [(t, n, float(v)) for n, v in zip(names, values, strict=True)]
    with ThreadPoolExecutor(max_workers=max(1, len(models))) as pool:
        list(pool.map(lambda item: item[1].write().save(model_path(path, item[0])),
                      models.items()))
    spark.createDataFrame(rows, "target string, term string, value double").coalesce(1).write \
        .parquet(f"{path}/{COEFFICIENTS}")
    committed.publish(spark, root, {
        "path": path, "targets": list(models), "spec": committed.spec_hash(terms),
        "files": committed.files_of(spark, path)})
    return root


def _published(spark: SparkSession, root: str) -> dict:
    found = committed.manifest(spark, root)
    if not found:
        raise FileNotFoundError(f"no model set is published at {root}")
    committed.check_files(spark, found)
    return found


def load_models(root: str, targets: Sequence[str]) -> dict:
    """Every target's model of the newest published set; a missing one fails fast."""
    from pyspark.ml.regression import LinearRegressionModel

    found = _published(SparkSession.active(), root)

    def load(t):
        p = model_path(found["path"], t)
        if t not in found["targets"]:
            raise FileNotFoundError(f"model for target {t!r} not loadable at {p}")
        return t, LinearRegressionModel.load(p)

    with ThreadPoolExecutor(max_workers=max(1, len(targets))) as pool:
        return dict(pool.map(load, targets))


def load_coefficients(spark: SparkSession, root: str) -> DataFrame:
    """``(target, term, value)`` of the newest published set."""
    return spark.read.parquet(f"{_published(spark, root)['path']}/{COEFFICIENTS}")
