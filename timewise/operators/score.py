"""Scoring: column alignment, row validation, prediction
summaries and monitoring histograms.  All are projections or aggregations
that work on batch and streaming frames."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(df: DataFrame, features: Sequence[str], fill: float = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """Columns in trained order; missing ones and nulls filled with ``fill``;
    extras dropped (``keep`` names pass-through key columns)."""
    have = set(df.columns)
    cols = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(fill)).alias(c) if c in have
            else F.lit(fill).cast("double").alias(c) for c in features]
    return df.select(*keep, *cols)


def validate(df: DataFrame, schema: Mapping[str, tuple[str, bool]], keep: Sequence[str] = ()) -> DataFrame:
    """Adds ``bad_reason`` (null for a good row).  ``schema``: column ->
    (spark type, required).  A value that does not convert is a type error;
    a required null (or absent column) is a missing error."""
    reasons = []
    casts = {}
    for c, (typ, required) in schema.items():
        if c not in df.columns:
            if required:
                reasons.append(F.lit(f"missing:{c}"))
            casts[c] = F.lit(None).cast(typ)
            continue
        raw = F.col(f"`{c}`")
        conv = raw.try_cast(typ) if typ != "string" else raw.cast("string")
        casts[c] = conv
        reasons.append(F.when(raw.isNotNull() & conv.isNull(), F.lit(f"type:{c}")))
        if required:
            reasons.append(F.when(raw.isNull(), F.lit(f"missing:{c}")))
    msg = F.concat_ws(";", *reasons) if reasons else F.lit("")
    out = df.select(*keep, *[v.alias(k) for k, v in casts.items()], msg.alias("bad_reason"))
    return out.withColumn("bad_reason", F.nullif(F.col("bad_reason"), F.lit("")))


def split_valid(df: DataFrame, schema, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    v = validate(df, schema, keep)
    return v.where(F.col("bad_reason").isNull()).drop("bad_reason"), v.where(F.col("bad_reason").isNotNull())


# Default upper bounds of the prediction histogram (+inf last).
DEFAULT_BUCKETS = (1000.0, 5000.0, 10000.0, 20000.0, 50000.0, 100000.0, float("inf"))


def score_histogram(df: DataFrame, col: str = "prediction", buckets: Sequence[float] = DEFAULT_BUCKETS,
                    by: Sequence[str] = ()) -> DataFrame:
    """Cumulative bucket counts (value <= bound), count and sum, in long form."""
    aggs = [F.count(F.col(col)).cast("long").alias("count"), F.sum(col).alias("sum")]
    aggs += [F.count_if(F.col(col) <= F.lit(float(b))).cast("long").alias(f"b{i}") for i, b in enumerate(buckets)]
    g = df.groupBy(*by).agg(*aggs)
    structs = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(buckets)]
    return g.select(*by, "count", "sum", F.explode(F.array(*structs)).alias("h")).select(
        *by, "count", "sum", "h.le", "h.cumulative")


def score_windows(df: DataFrame, ts: str, col: str, every: str = "15 seconds",
                  watermark: str | None = "30 seconds", buckets: Sequence[float] = DEFAULT_BUCKETS) -> DataFrame:
    """Per tumbling window: count, sum, and cumulative bucket counts (wide).
    With a watermark this runs in append mode on a stream; late rows beyond
    the watermark are dropped by Spark's state store."""
    src = df
    if watermark and df.isStreaming:
        from pyspark.sql.types import TimestampNTZType
        if isinstance(df.schema[ts].dataType, TimestampNTZType):
            # event-time watermarks need TIMESTAMP; read the wall time in the session zone
            src = src.withColumn(ts, F.col(ts).cast("timestamp"))
        src = src.withWatermark(ts, watermark)
    aggs = [F.count(F.col(col)).cast("long").alias("count"), F.sum(col).alias("sum")]
    aggs += [F.count_if(F.col(col) <= F.lit(float(b))).cast("long").alias(f"le_{i}") for i, b in enumerate(buckets)]
    g = src.groupBy(F.window(ts, every).alias("w")).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def score_summary(pred: DataFrame, col: str = "prediction") -> tuple[DataFrame, DataFrame]:
    """(predictions with a scoring time stamp, one-row batch summary)."""
    stamped = pred.withColumn("scored_at", F.current_timestamp())
    summary = pred.agg(F.count(F.col(col)).cast("long").alias("n_predictions"),
                       F.avg(col).alias("mean_prediction"), F.current_timestamp().alias("scored_at"))
    return stamped, summary
