"""Scoped persistence for multi-job fits.

A fit that runs several jobs over the same input (statistics, then a
ranking, then a collect) would recompute the input's whole lineage for each
job.  ``held`` persists the input (memory, spilling to disk) for the scope
of the fit and releases it afterwards; an input the caller already cached
is left alone.  Lost blocks are recomputed from lineage, so executor loss
is survived.

A held frame keeps the shuffle files of the plan below it, and a frame that is
fitted on and then returned runs its plan twice.  ``settled`` and ``cut`` are
for tables whose plan moves more than its few columns hold: the rows are
written once to the shared folder, and the plan's files go."""
from __future__ import annotations

import re
import threading
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from timewise.session import ensure_checkpoint_dir

_LOCK = threading.Lock()     # the setting is the session's: folds that are fitted side by side take turns
_LAYOUT = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def _persist(df: DataFrame, as_planned: bool) -> None:
    """Persist; ``as_planned`` keeps the partitions that the plan would have
    without the cache (the setting is read when the plan is registered)."""
    conf = df.sparkSession.conf
    with _LOCK:
        was = conf.get(_LAYOUT, None)
        if as_planned:
            conf.set(_LAYOUT, "true")
        try:
            df.persist(StorageLevel.MEMORY_AND_DISK)
        finally:
            if as_planned:
                conf.unset(_LAYOUT) if was is None else conf.set(_LAYOUT, was)


@contextmanager
def held(df: DataFrame, as_planned: bool = False):
    if df.isStreaming or df.storageLevel != StorageLevel.NONE or _reads_settled(df):
        yield df
        return
    _persist(df, as_planned)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def held_part(df: DataFrame, part: DataFrame, as_planned: bool = False):
    """``held`` for ``part``, a projection of ``df``: where ``df`` is cached
    already, the projection reads that and is not stored a second time."""
    if df.isStreaming or df.storageLevel != StorageLevel.NONE:
        yield part
        return
    with held(part, as_planned):
        yield part


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that nothing
    refers to any more; it learns of them when the driver collects garbage."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SETTLED = "settled"


def settled(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: a column is stored
    once however often it is read, and readers take the columns they need.
    Projections of it are not held on top."""
    from timewise.sources.io import scratch_path
    path = scratch_path(df.sparkSession, _SETTLED)
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _reads_settled(df: DataFrame) -> bool:
    """Whether ``df`` is a mere projection or choice of rows of settled ones."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if {re.match(r"[\s:+-]*(\w*)", x)[1] for x in plan.splitlines()} - {"Project", "Filter", "Relation"}:
        return False
    files = df.inputFiles()
    return bool(files) and all(f"/timewise-{_SETTLED}/" in f for f in files)


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed: rows, their order and their partitions stay."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint()
    release(df.sparkSession)
    return out
