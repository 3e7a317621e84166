"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the session is created by the caller; library code only *reads*
``spark.checkpoint.dir`` (the shared folder the cluster names) and writes
intermediate tables below it.  A local default is set only when it is unset.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Where the fallback root is remembered when the session names none
# (spark.checkpoint.dir itself cannot be changed on a running session).
FALLBACK_CONF = "dayflow.scratch.root"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "dayflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DAYFLOW_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root.

    The cluster's ``spark.checkpoint.dir`` is used when set.  Only when the
    session names none *and* runs on a ``local`` master is a local fallback
    chosen; it is recorded under ``dayflow.scratch.root`` and given to
    ``setCheckpointDir``.  On any other master a missing setting raises: a
    folder of one machine cannot hold what all executors share.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.conf.get(FALLBACK_CONF, None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all "
                             f"executors of {master} share")
        root = os.path.join(os.environ.get("DAYFLOW_SCRATCH", "/tmp"), "dayflow-checkpoints")
        spark.conf.set(FALLBACK_CONF, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def share_code(spark: SparkSession) -> None:
    """Let Python workers find this library where it is not installed.

    A driver that was started outside the library's folder has it on its own path
    only.  The folder is added to the workers' search path; where the library is
    installed on the executors, this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory below this application's scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """Where this application writes its intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/dayflow/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove every intermediate table that this application has written.

    Results that still read them become unreadable, so only the caller can say
    when: call it once results are written elsewhere.  Returns whether there
    was anything to remove.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)


def materialize(df, name: str):
    """Cut lineage: write ``df`` once as Parquet below the shared checkpoint
    root and return the re-read table.

    Unlike ``Dataset.checkpoint``, whose reliable write recomputes an uncached
    plan a second time, the plan runs once; the result is durable (it survives
    executor loss) and later scans get Parquet column pruning and statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
