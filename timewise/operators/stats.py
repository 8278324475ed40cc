"""Distributed statistics shared by several operators.

``quantiles`` is exact and never orders rows: equal values are first counted
(a grouped count, combined map-side), so a value that fills most of a column is
one row from there on.  The counts, one row per distinct value, are put in
order with the partitioned prefix helper; the value that covers a rank follows
from the running count, and the linear interpolation runs on the two values
per probability that are left.  ``method='approx'`` uses ``percentile_approx``
instead (one pass, bounded memory).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timewise.functions.numeric import finite
from timewise.plans.prefix import running_totals


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), finite_only: bool = True) -> DataFrame:
    """(by..., column, value) for every non-null value of the given columns."""
    val = (lambda c: finite(c)) if finite_only else (lambda c: F.col(c).cast("double"))
    wide = df.select(*by, *[val(c).alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "column", "value").where(F.col("value").isNotNull())


def _pname(p: float) -> str:
    return f"p{round(p * 100, 4):g}".replace(".", "_")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              method: str = "exact", accuracy: int = 10_000, finite_only: bool = True) -> DataFrame:
    """One row per (by..., column) with a column per probability (``p25``, ``p50`` ...).

    Exact values use linear interpolation between order statistics (the
    usual 'linear' definition of numpy, pandas and DuckDB's quantile_cont)."""
    long = long_values(df, cols, by, finite_only)
    keys = [*by, "column"]
    names = [_pname(p) for p in probs]
    if method == "approx":
        return long.groupBy(*keys).agg(*[F.percentile_approx("value", p, accuracy).alias(n)
                                          for p, n in zip(probs, names)])
    return quantiles_of_counts(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_c")), keys, probs)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The exact quantiles from (keys..., value, _c): how often each value occurs."""
    names = [_pname(p) for p in probs]
    j = running_totals(counts, [F.col("value").asc()], {"_before": F.col("_c")}, partition_by=keys,
                       totals=True).withColumnRenamed("_before__total", "_n")
    pos = {n: F.lit(p) * (F.col("_n") - 1).cast("double") for p, n in zip(probs, names)}
    lo = {n: F.floor(pos[n]).cast("long") for n in names}

    def covers(rank):
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c"))

    wanted = None
    for n in names:
        cond = covers(lo[n]) | covers(lo[n] + 1)
        wanted = cond if wanted is None else wanted | cond
    few = j.where(wanted)
    aggs = []
    for n in names:
        v_lo = F.max(F.when(covers(lo[n]), F.col("value")))
        v_hi = F.coalesce(F.max(F.when(covers(lo[n] + 1), F.col("value"))), v_lo)
        frac = F.first(pos[n] - lo[n].cast("double"))
        aggs.append((v_lo + (v_hi - v_lo) * frac).alias(n))
    return few.groupBy(*keys).agg(*aggs)


def median_map(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict[str, float | None]:
    """Median of each column's finite values, collected (one number per column).

    The exact one takes two passes and orders next to nothing: the first brackets
    each median between two approximate quantiles, the second counts the values
    in the bracket one by one and all those below and above it as one value each.
    A column whose bracket misses its median has all its values counted."""
    if not cols:
        return {}
    if method == "exact":
        got = _bracketed_medians(df, cols)
        missed = [c for c in cols if c in got and not math.isfinite(got[c])]
    else:
        got, missed = {}, list(cols)
    if missed:
        rows = quantiles(df, missed, [0.5], method=method).collect()  # one row per column
        got.update({r["column"]: r["p50"] for r in rows})
    return {c: got.get(c) for c in cols}


BRACKET = 4e-3           # share of the rows on either side of a median that its bracket is to hold
SKETCH = 500             # accuracy of its ends: small sketches, as all tasks' meet in one


def _bracketed_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """column -> median; not finite where the bracket missed it."""
    wide = df.select(*[finite(f"`{c}`").alias(f"_{i}") for i, c in enumerate(cols)])
    ends = wide.agg(*[F.percentile_approx(f"_{i}", [0.5 - BRACKET, 0.5 + BRACKET], SKETCH).alias(f"_{i}") for i in range(len(cols))]).first()
    known = {i: ends[f"_{i}"] for i in range(len(cols)) if ends[f"_{i}"]}
    if not known:
        return {}
    clipped = wide.select(*[F.when(F.col(f"_{i}") < lo, -math.inf).when(F.col(f"_{i}") > hi, math.inf).otherwise(F.col(f"_{i}")).alias(f"_{i}")
                            for i, (lo, hi) in known.items()])
    long = long_values(clipped, clipped.columns, finite_only=False)
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    return {cols[int(r["column"][1:])]: r["p50"] for r in quantiles_of_counts(counts, ["column"], [0.5]).collect()}


def nan_to_none(v):
    if v is None:
        return None
    try:
        return None if math.isnan(v) else v
    except TypeError:
        return v
