"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, the DuckDB oracle text.

Conventions that keep both sides comparable: doubles are rounded to 6
places, integers are BIGINT, every computed column carries the same alias.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from timewise.plans import q_clean, q_encode, q_folds, q_metrics, q_explain, q_io, q_profile, q_sanitize, q_score, q_select, q_shape  # noqa: F401
