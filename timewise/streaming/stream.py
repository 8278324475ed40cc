"""Structured Streaming entry points: scoring arriving files with a fitted
pipeline, and windowed prediction monitoring with a watermark.

A fitted pipeline's transform is a projection (plus broadcast joins of
fixed state tables), so the same object scores a batch and a stream."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from timewise.operators.score import DEFAULT_BUCKETS, score_windows
from timewise.sources.io import read_stream


def score_stream(spark: SparkSession, source_dir: str, schema, transform: Callable[[DataFrame], DataFrame],
                 sink_dir: str, checkpoint_dir: str, fmt: str = "parquet", available_now: bool = True,
                 sink_fmt: str = "parquet") -> StreamingQuery:
    """readStream -> transform -> writeStream; exactly-once file sink with a
    checkpoint on shared storage, so a restarted job resumes where it stopped."""
    src = read_stream(spark, source_dir, schema, fmt)
    out = transform(src)
    w = out.writeStream.format(sink_fmt).option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 seconds")
    return w.outputMode("append").start()


def score_metrics_stream(stream: DataFrame, ts: str, col: str, sink_dir: str, checkpoint_dir: str,
                         every: str = "15 seconds", watermark: str | None = "30 seconds",
                         buckets: Sequence[float] = DEFAULT_BUCKETS, available_now: bool = True) -> StreamingQuery:
    """Windowed prediction histogram in update mode: each micro-batch writes
    the windows it changed, with its batch number, so open windows show at
    once and the newest one is there at the end of the input.  Read the sink
    with :func:`read_windows`.  A batch is written to a folder of its own and
    overwritten on a retry, so a restarted job leaves no doubles.

    ``watermark`` bounds the state and the lateness that still counts; None
    keeps every window open (for inputs that end)."""
    agg = score_windows(stream, ts, col, every, watermark, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    w = agg.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.outputMode("update").start()


def read_windows(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The latest state of every window written so far."""
    from pyspark.sql import functions as F
    rows = spark.read.parquet(sink_dir)
    values = [c for c in rows.columns if c not in ("window_start", "window_end", "batch")]
    last = rows.groupBy("window_start", "window_end").agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return last.select("window_start", "window_end", "v.*")
