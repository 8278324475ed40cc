"""Learning rows: which labelled documents a classifier may see."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(folds))


def learning_rows(labels: DataFrame, column: str, folds: int, held_out: int, limit: int) -> DataFrame:
    """(doc_id, y) of at most ``limit`` labelled rows outside the held-out
    fold: those with the least hash of their id, so the sample does not depend
    on the order or layout of the table.  One label per id (the least)."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{column}`").cast("int").alias("y"))
            .where("doc_id is not null and y in (0, 1)").where(fold("doc_id", folds) != held_out))
    return (rows.groupBy("doc_id").agg(F.min("y").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
