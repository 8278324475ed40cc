"""Connected components of an edge table, as alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the least
    node reachable.  Nodes are of any ordered type; null ends and loops are
    ignored (a node with only loops is absent).

    Each round hangs larger neighbours on the least neighbour (large star),
    then lower neighbours on the least (small star).  Rounds are logarithmic
    in practice.  Every round aggregates map-side to one minimum per node,
    the joins on hub nodes are plain equi-joins that AQE may split, and the
    lineage is cut by a checkpoint, so neither links nor labels ever reach
    the driver (it sees one count and one checksum a round).
    """
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = checkpointed(e)
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = checkpointed(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
