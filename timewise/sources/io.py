"""Sources and sinks: tables in CSV/parquet/JSON, reports,
fitted state, run logs and a file drop-in stream source.

Scratch output goes under the session's checkpoint folder, which on a
cluster is shared storage; nothing is written to a machine-local folder."""
from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from timewise.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/timewise-{name}/{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "csv",
               **options) -> DataFrame:
    """CSV with header (schema given, no inference pass) or parquet/json."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    if schema is not None:
        r = r.schema(schema)
    elif fmt == "csv":
        r = r.option("inferSchema", "true")
    return r.options(**options).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", **options) -> str:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.options(**options).save(path)
    return path


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A small result table as JSON lines (one file per partition)."""
    df.write.mode(mode).json(path)
    return path


def save_state(spark: SparkSession, path: str, state: Mapping, tables: Mapping[str, DataFrame] | None = None) -> None:
    """Fitted state: a JSON document plus parquet tables (e.g. encoding tables)."""
    spark.createDataFrame([(json.dumps(state, default=float),)], "state string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/state.json")
    for name, t in (tables or {}).items():
        t.write.mode("overwrite").parquet(f"{path}/tables/{name}")


def load_state(spark: SparkSession, path: str, table_names: Sequence[str] = ()) -> tuple[dict, dict]:
    text = spark.read.text(f"{path}/state.json").first()[0]
    tables = {n: spark.read.parquet(f"{path}/tables/{n}") for n in table_names}
    return json.loads(text), tables


RUN_SCHEMA = "run_id string, ts timestamp, kind string, key string, value string"


def log_run(spark: SparkSession, path: str, run_id: str, kind: str, values: Mapping) -> None:
    """Append (run_id, ts, kind, key, value) rows: params, metrics, shapes, feature names."""
    ts = time.time()
    from datetime import datetime, timezone
    now = datetime.fromtimestamp(ts, tz=timezone.utc).replace(tzinfo=None)
    rows = [(run_id, now, kind, str(k), json.dumps(v, default=str) if not isinstance(v, str) else v)
            for k, v in values.items()]
    spark.createDataFrame(rows, RUN_SCHEMA).write.mode("append").parquet(path)


def log_metrics_table(df: DataFrame, path: str, run_col: str, kind: str = "metric") -> None:
    """Append a wide metrics table as run-log rows (one run per ``run_col`` value), as a Spark job."""
    cols = [c for c in df.columns if c != run_col]
    long = df.select(F.col(run_col).cast("string").alias("run_id"),
                     *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["run_id"], cols, "key", "value")
    long.select("run_id", F.current_timestamp().alias("ts"), F.lit(kind).alias("kind"), "key", "value").write.mode(
        "append").parquet(path)


def run_log_pivot(spark: SparkSession, path: str, kind: str = "metric", keys: Sequence[str] | None = None) -> DataFrame:
    """Compare runs: one row per run, one column per key (latest value wins)."""
    log = spark.read.parquet(path).where(F.col("kind") == kind)
    latest = log.groupBy("run_id", "key").agg(F.max_by("value", "ts").alias("value"))
    keys = list(keys) if keys is not None else sorted(r["key"] for r in latest.select("key").distinct().collect())
    return latest.groupBy("run_id").pivot("key", keys).agg(F.first("value"))


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File drop-in source: every new file in ``path`` is a micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
