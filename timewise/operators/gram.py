"""Products of columns with columns, by dense row blocks.

A batch of rows is one dense block; its cross products are a matrix product,
added up within the task and emitted as tiles of ``TILE`` x ``TILE`` columns,
which a shuffle adds up by tile.  So neither rows nor expressions multiply with
the number of column pairs, and 500 columns are as easy as 10.  The driver
receives the final matrix: (number of columns)^2 values.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 128


def cross_products(df: DataFrame, cols: Sequence[str], by: str | None = None, pairwise: bool = False) -> dict:
    """By value of ``by`` (None without): Z'Z of the columns, nulls as 0, or
    with ``pairwise`` a stack [Z'Z, (Z^2)'M, Z'M, M'M], M marking the non-null
    cells: per pair (i, j), over the rows where both are present, the sums of
    z_i z_j, z_i^2, z_i and 1."""
    names, p = [f"z{i}" for i in range(len(cols))], len(cols)
    if p == 0:
        return {}
    rows = df.select(*([F.col(by).alias("_by")] if by else [F.lit(None).cast("long").alias("_by")]), *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    kind = dict(rows.dtypes)["_by"]
    layers = 4 if pairwise else 1

    def run(batches):
        total: dict = {}
        for b in batches:
            z = np.column_stack([b.column(c).fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in names])
            gap = np.isnan(z)
            z[gap] = 0.0
            keys = b.column("_by").to_pylist()
            for key in set(keys):
                at = np.array([k == key for k in keys]) if by else slice(None)
                x = z[at]
                if pairwise:
                    m = (~gap[at]).astype(np.float64)
                    out = np.stack([x.T @ x, (x * x).T @ m, x.T @ m, m.T @ m])
                else:
                    out = (x.T @ x)[None]
                total[key] = total[key] + out if key in total else out
        rows = [(key, i, j, np.ascontiguousarray(g[:, i:i + TILE, j:j + TILE]).tobytes())
                for key, g in total.items() for i in range(0, p, TILE) for j in range(0, p, TILE)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], key_type), *[pa.array(c) for c in list(zip(*rows))[1:]]], ["_by", "i", "j", "tile"])

    key_type = pa.int64() if kind in ("bigint", "int") else pa.string() if kind == "string" else None

    def add(group: pa.Table) -> pa.Table:
        tile = sum(np.frombuffer(t.as_py(), np.float64) for t in group.column("tile"))
        return pa.table({"_by": group.column("_by").slice(0, 1), "i": group.column("i").slice(0, 1), "j": group.column("j").slice(0, 1),
                         "tile": pa.array([tile.tobytes()], pa.binary())})

    if kind == "int":
        rows, kind = rows.withColumn("_by", F.col("_by").cast("long")), "bigint"
    tiles = rows.mapInArrow(run, f"_by {kind}, i long, j long, tile binary").groupBy("_by", "i", "j").applyInArrow(add, f"_by {kind}, i long, j long, tile binary")
    out: dict = {}
    for r in tiles.collect():
        g = out.setdefault(r["_by"], np.zeros((layers, p, p)))
        h, w = min(TILE, p - r["i"]), min(TILE, p - r["j"])
        g[:, r["i"]:r["i"] + h, r["j"]:r["j"] + w] = np.frombuffer(r["tile"], np.float64).reshape(layers, h, w)
    return {k: g if pairwise else g[0] for k, g in out.items()}


def correlations(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson r of every pair over the rows where both are present (NaN
    where undefined); the diagonal is 1 where the column varies.  Columns are
    shifted by their means first, so that large values lose no digits."""
    means = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shifted = df.select(*[(F.col(c) - F.lit(means[f"m{i}"])).alias(f"s{i}") for i, c in enumerate(cols)])
    got = cross_products(shifted, [f"s{i}" for i in range(len(cols))], pairwise=True)
    p = len(cols)
    sxy, sxx, sx, n = got.get(None, np.zeros((4, p, p)))
    with np.errstate(all="ignore"):
        vx = sxx - sx * sx / n
        r = (sxy - sx * sx.T / n) / np.sqrt(vx * vx.T)
        scale = sxx * 1e-13
        r[(vx <= scale) | (vx.T <= scale.T) | (n < 2)] = np.nan
    flat = np.diag(vx) <= np.diag(scale)
    r[np.arange(p), np.arange(p)] = np.where(flat | (np.diag(n) < 2), np.nan, 1.0)
    return np.clip(r, -1.0, 1.0)
