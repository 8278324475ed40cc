"""Ordered running totals without a single-task window.

A window ``ORDER BY`` with no ``PARTITION BY`` runs in one task.  Here the
rows are range-partitioned on the full sort key (Spark samples the key and
balances the ranges, so a hot date or category is split over many blocks),
the partition number becomes a block id, and the block is checkpointed so
that every reader sees the same block assignment even after an executor is
lost.  Then

1. a window partitioned by (block, group) gives the running total inside the
   block;
2. totals per (block, group) - at most #groups + #blocks rows - give, by a
   window partitioned by group, the sum of earlier blocks of the same group;
3. only groups continued from an earlier block need an offset: at most
   #blocks - 1 rows, so that table is broadcast with a proven bound.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timewise.plans.cache import held
from timewise.session import ensure_checkpoint_dir

BLOCK = "_tw_blk"


def default_blocks(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _null_safe_on(cols: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    cond = left[BLOCK] == right[BLOCK]
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def in_blocks(df: DataFrame, order_by: Sequence[Column], n_blocks: int | None = None, checkpoint: bool = True) -> DataFrame:
    """``df`` range-partitioned on the full sort key, with the partition
    number as block id (column ``BLOCK``): blocks are in key order.

    The range sampler and the shuffle both read the held source, so the
    upstream plan runs once; the checkpoint then fixes the blocks."""
    spark = df.sparkSession

    def cut(src: DataFrame) -> DataFrame:
        return (src.repartitionByRange(n_blocks or default_blocks(spark), *order_by)
                .withColumn(BLOCK, F.spark_partition_id()))

    if not checkpoint:
        return cut(df)
    ensure_checkpoint_dir(spark)
    with held(df):
        return cut(df).checkpoint(eager=True)


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    measures: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    inclusive: bool = False,
    n_blocks: int | None = None,
    checkpoint: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Add one column per measure holding its sum over the rows before this
    one (or up to and including it when ``inclusive``) in ``order_by`` order
    within ``partition_by`` groups.  ``order_by`` must be a total order (end it
    with a unique tie key) for the result to be deterministic.  ``totals``
    also adds ``<measure>__total``, the group's full sum, taken from the
    block table (no second pass over the rows)."""
    part_cols = [F.col(c).asc_nulls_first() for c in partition_by]
    tmp = {m: f"_tw_m_{m}" for m in measures}
    src = df.select("*", *[e.alias(tmp[m]) for m, e in measures.items()])
    ranged = in_blocks(src, [*part_cols, *order_by], n_blocks, checkpoint)

    frame_end = Window.currentRow if inclusive else -1
    w_local = (
        Window.partitionBy(BLOCK, *partition_by)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, frame_end)
    )
    block_tot = ranged.groupBy(BLOCK, *partition_by).agg(
        *[F.sum(tmp[m]).alias(f"_tw_t_{m}") for m in measures]
    )
    w_blocks = Window.partitionBy(*partition_by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = block_tot.select(
        BLOCK, *partition_by,
        *[F.sum(f"_tw_t_{m}").over(w_blocks).alias(f"_tw_o_{m}") for m in measures],
        F.count(F.lit(1)).over(w_blocks).alias("_tw_prev"),
    ).where(F.col("_tw_prev") > 0).drop("_tw_prev")
    # At most n_blocks - 1 rows survive: each block boundary continues one group.
    offsets = F.broadcast(offsets)

    local = ranged.select("*", *[F.sum(tmp[m]).over(w_local).alias(f"_tw_l_{m}") for m in measures])
    joined = local.join(offsets, _null_safe_on(partition_by, local, offsets), "left")
    zero = F.lit(0)
    out_cols = [local[c] for c in df.columns]
    for m in measures:
        out_cols.append(
            (F.coalesce(local[f"_tw_l_{m}"], zero.cast(local.schema[tmp[m]].dataType))
             + F.coalesce(offsets[f"_tw_o_{m}"], zero.cast(local.schema[tmp[m]].dataType))).alias(m)
        )
    if totals:
        group_tot = block_tot.groupBy(*partition_by).agg(
            *[F.sum(f"_tw_t_{m}").alias(f"{m}__total") for m in measures])
        res = joined.select(*out_cols, *[local[c] for c in partition_by if c not in df.columns])
        if partition_by:
            cond = None
            for c in partition_by:
                e = res[c].eqNullSafe(group_tot[c])
                cond = e if cond is None else cond & e
            return res.join(group_tot, cond, "left").select(
                *[res[c] for c in res.columns], *[group_tot[f"{m}__total"] for m in measures])
        row = group_tot.first()  # one row: the grand totals become literals
        return res.withColumns({f"{m}__total": F.lit(row[f"{m}__total"]) for m in measures})
    return joined.select(*out_cols)


def row_index(df: DataFrame, order_by: Sequence[Column], name: str = "row_idx", **kw) -> DataFrame:
    """0-based position of every row in ``order_by`` order (global, no single-task window)."""
    return running_totals(df, order_by, {name: F.lit(1).cast("long")}, **kw)
