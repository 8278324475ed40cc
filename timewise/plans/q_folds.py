"""Registered queries for ordering, splits and folds."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.operators import folds as FO
from timewise.plans.common import KEY4, KEY4_SQL, normalize
from timewise.plans.fixtures import TIE_KEY, sales, with_sales
from timewise.plans.registry import query

_IDX = ("ix AS (SELECT *, row_number() OVER (ORDER BY saleDate ASC NULLS LAST, " + ", ".join(TIE_KEY)
        + ") - 1 AS row_idx, count(*) OVER () AS n_rows FROM sales)")


def _indexed(spark, sf):
    return FO.time_index(sales(spark, sf), "saleDate", TIE_KEY)


@query("time_index", with_sales(f"SELECT {KEY4_SQL}, row_idx, n_rows FROM ix", _IDX))
def q_time_index(spark, sf):
    return normalize(_indexed(spark, sf).select(*KEY4, "row_idx", "n_rows"))


def _folds_sql(k=3):
    parts = []
    for i in range(k):
        start = f"(n_rows - {k - i} * (n_rows // {k + 1}))"
        parts.append(f"SELECT {KEY4_SQL}, CAST({i} AS BIGINT) AS fold, CASE WHEN row_idx < {start} THEN 'train' "
                     f"ELSE 'test' END AS role FROM ix WHERE row_idx < {start} + n_rows // {k + 1}")
    return " UNION ALL ".join(parts)


@query("time_folds", with_sales(_folds_sql(), _IDX))
def q_time_folds(spark, sf):
    return normalize(FO.time_folds(_indexed(spark, sf), 3).select(*KEY4, "fold", "role"))


@query("holdout", with_sales(f"SELECT {KEY4_SQL}, CASE WHEN row_idx >= n_rows - ceil(0.2 * n_rows) THEN 'test' "
                             "ELSE 'train' END AS role FROM ix", _IDX))
def q_holdout(spark, sf):
    return normalize(FO.holdout(_indexed(spark, sf), 0.2).select(*KEY4, "role"))


@query("block_folds", with_sales(f"""
SELECT {KEY4_SQL}, CAST(CASE WHEN row_idx < (n_rows % 5) * (n_rows // 5 + 1) THEN row_idx // (n_rows // 5 + 1)
       ELSE (n_rows % 5) + (row_idx - (n_rows % 5) * (n_rows // 5 + 1)) // (n_rows // 5) END AS BIGINT) AS fold
FROM ix""", _IDX))
def q_block_folds(spark, sf):
    return normalize(FO.block_folds(_indexed(spark, sf), 5).select(*KEY4, "fold"))
