"""Shared helpers: session folders, table reading, lineage cuts."""
from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from timewise.session import ensure_checkpoint_dir


_tidied = [0.0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    The folder is the one the session names in ``spark.checkpoint.dir``; a
    scratch folder is made only on a local master where that is unset, on a
    cluster its absence is an error.  Every few seconds this first lets go of
    the files that earlier steps left (see ``tidy``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    if time.monotonic() - _tidied[0] > 4:
        tidy(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle and checkpoint files of steps
    that nothing refers to any more.  It only learns of them when the driver
    collects its garbage, which in a short driver is after the whole job."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _tidied[0] = time.monotonic()


BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table (ids, hashes) cut from its lineage and counted; marked
    for broadcast only where it has at most ``limit`` rows, else left to an
    ordinary shuffled join."""
    from pyspark.sql import functions as F
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= limit else df


def joined_few(big: DataFrame, few: DataFrame, key: str, rest: dict | None = None) -> DataFrame:
    """``big`` joined with ``few`` (rows for some of its keys) on ``key``, so
    that only the rows of ``big`` that have a partner are shuffled, as long as
    the keys may be broadcast (see ``small``).  With ``rest``, values of the
    columns of ``few`` by name, the rows without a partner are kept too."""
    keys = small(few.select(key).distinct())
    hit = big.join(keys, key, "left_semi").join(few, key)
    if rest is None:
        return hit
    other = big.join(keys, key, "left_anti").select(*[c for c in big.columns], *[v.alias(k) for k, v in rest.items()])
    return hit.select(*big.columns, *rest).unionByName(other)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def as_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, under fixed names, so that
    extra or clashing columns of the input never matter.  A null text is an
    empty text.

    Whole texts are large rows: ten thousand of them, the default Arrow batch,
    would take tens of MB in the executor and again in its worker.  Unless the
    session says otherwise, batches get 2000."""
    from pyspark.sql import functions as F
    conf = df.sparkSession.conf
    if conf.get(ARROW_ROWS) == "10000":
        conf.set(ARROW_ROWS, "2000")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
