"""Registered queries for scoring and streaming."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.operators import score as SC
from timewise.plans.common import KEY4, KEY4_SQL, normalize
from timewise.plans.fixtures import clean_sales, sales, with_clean, with_sales
from timewise.plans.q_metrics import PRED_CTE, predictions
from timewise.plans.registry import query
from timewise.session import read

ALIGN = ["kilometers", "cubeCapacity", "colour__purple", "powerKW", "km_per_year"]


@query("align_columns", with_clean(
    f"SELECT {KEY4_SQL}, " + ", ".join(
        f"round(coalesce({c}, 0.0), 6) AS {c}" if c != "colour__purple" else "CAST(0.0 AS DOUBLE) AS colour__purple" for c in ALIGN)
    + " FROM st"))
def q_align(spark, sf):
    s = clean_sales(spark, sf)
    return normalize(SC.align(s, ALIGN, keep=KEY4))


VALID = {"doorNumber": ("double", False), "kilometers": ("double", True), "colour": ("string", True),
         "saleDate": ("date", True)}


@query("validate_rows", with_sales(f"""
SELECT {KEY4_SQL}, TRY_CAST(doorNumber AS DOUBLE) AS doorNumber, kilometers, colour, saleDate,
       nullif(concat_ws(';',
         CASE WHEN doorNumber IS NOT NULL AND TRY_CAST(doorNumber AS DOUBLE) IS NULL THEN 'type:doorNumber' END,
         CASE WHEN kilometers IS NOT NULL AND TRY_CAST(kilometers AS DOUBLE) IS NULL THEN 'type:kilometers' END,
         CASE WHEN kilometers IS NULL THEN 'missing:kilometers' END,
         CASE WHEN colour IS NOT NULL AND CAST(colour AS VARCHAR) IS NULL THEN 'type:colour' END,
         CASE WHEN colour IS NULL THEN 'missing:colour' END,
         CASE WHEN saleDate IS NOT NULL AND TRY_CAST(saleDate AS DATE) IS NULL THEN 'type:saleDate' END,
         CASE WHEN saleDate IS NULL THEN 'missing:saleDate' END), '') AS bad_reason
FROM sales"""))
def q_validate(spark, sf):
    return normalize(SC.validate(sales(spark, sf), VALID, keep=KEY4))


def _hist_sql():
    b = SC.DEFAULT_BUCKETS
    parts = []
    for i, v in enumerate(b):
        le = "CAST('inf' AS DOUBLE)" if v == float("inf") else repr(v)
        parts.append(f"SELECT model, count(p2) AS count, round(CAST(sum(p2) AS DOUBLE), 6) AS sum, "
                     f"{le} AS le, count(CASE WHEN p2 <= {le} THEN 1 END) AS cumulative FROM q GROUP BY model")
    return (f"WITH {PRED_CTE}, q AS (SELECT model, CAST(round(p, 2) AS DECIMAL(18,2)) AS p2 FROM pr) "
            + " UNION ALL ".join(parts))


@query("score_histogram", _hist_sql())
def q_hist(spark, sf):
    pr = predictions(spark, sf).select("model", F.round("p", 2).cast("decimal(18,2)").alias("p2"))
    return normalize(SC.score_histogram(pr, "p2", by=["model"]))


def _win_sql():
    b = SC.DEFAULT_BUCKETS
    cols = ", ".join(
        f"count(CASE WHEN v <= {'CAST(' + chr(39) + 'inf' + chr(39) + ' AS DOUBLE)' if x == float('inf') else repr(x)} THEN 1 END) AS le_{i}"
        for i, x in enumerate(b))
    return f"""
SELECT to_timestamp(floor(epoch(ts) / 15) * 15)::TIMESTAMP AS window_start,
       to_timestamp(floor(epoch(ts) / 15) * 15 + 15)::TIMESTAMP AS window_end,
       count(v) AS count, round(CAST(sum(v) AS DOUBLE), 6) AS sum, {cols}
FROM (SELECT ts, CAST(value * 100 AS DECIMAL(18,2)) AS v FROM events) GROUP BY 1, 2"""


@query("score_windows", _win_sql())
def q_windows(spark, sf):
    ev = read(spark, sf, "events").select("ts", (F.col("value") * 100).cast("decimal(18,2)").alias("v"))
    return normalize(SC.score_windows(ev, "ts", "v", "15 seconds"))


@query("score_summary", "WITH " + PRED_CTE + " SELECT count(p) AS n_predictions, round(avg(p), 6) AS mean_prediction FROM pr")
def q_summary(spark, sf):
    _, summary = SC.score_summary(predictions(spark, sf).withColumnRenamed("p", "prediction"))
    return normalize(summary.drop("scored_at"))
