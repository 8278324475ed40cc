"""Session helpers.

Library code never creates a session on its own; these helpers are for
tests, the bench and command-line use.  Cluster settings (checkpoint
folder, shuffle partitions) are read from the session and only filled in
where unset.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # fall back from whole-stage codegen when a generated method is too large
    # for the JVM's JIT (8000 bytes); wide text-cleaning projections hit it
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # ordered running totals checkpoint full rows; compress what goes to the
    # (shared) checkpoint folder
    "spark.checkpoint.compress": "true",
}


def local_session(cores: int | str = "*", app: str = "timewise", **conf) -> SparkSession:
    """A local session with sane defaults (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the cluster and must be on
    shared storage; it is used as is, and its absence is an error.  Only a
    local session without one (tests, single-machine runs) gets a scratch
    folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="timewise-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def default_parallelism(spark: SparkSession) -> int:
    """Partition count for explicit repartitions: the session's shuffle
    partitions (sized by the cluster), never below the cores available."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(n, spark.sparkContext.defaultParallelism)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
