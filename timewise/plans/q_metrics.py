"""Registered queries for evaluation metrics."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.operators import metrics as ME
from timewise.operators.profile import melt
from timewise.plans.common import normalize
from timewise.plans.registry import query
from timewise.session import read

PRED_CTE = """pr AS (
  SELECT l_orderkey, l_linenumber, l_returnflag AS model, l_linestatus AS fold,
         l_extendedprice AS y, l_quantity * p_retailprice AS p,
         CASE WHEN l_discount = 0.0 THEN 0.0 ELSE l_extendedprice END AS y0
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def predictions(spark, sf):
    li = read(spark, sf, "lineitem")
    pa = read(spark, sf, "part").select("p_partkey", "p_retailprice")
    j = li.join(pa, li.l_partkey == pa.p_partkey)
    return j.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("model"),
                    F.col("l_linestatus").alias("fold"), F.col("l_extendedprice").alias("y"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
                    F.when(F.col("l_discount") == 0.0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("y0"))


def metrics_sql(y, p, by=(), src="pr", rounded=True):
    e = f"({y} - {p})"
    rd = "round" if rounded else ""
    g = ", ".join(by)
    sel = (g + ", ") if by else ""
    return f"""
SELECT {sel}count(*) AS n, {rd}(sqrt(avg({e} * {e})){", 6" if rounded else ""}) AS rmse, {rd}(avg(abs({e})){", 6" if rounded else ""}) AS mae,
  {rd}(CASE WHEN var_pop({y}) * count(*) = 0 THEN CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END
        ELSE 1.0 - sum({e} * {e}) / (var_pop({y}) * count(*)) END{", 6" if rounded else ""}) AS r2,
  {rd}(coalesce(avg(CASE WHEN {y} <> 0 THEN abs({e} / {y}) END) * 100.0, CAST('inf' AS DOUBLE)){", 6" if rounded else ""}) AS mape,
  {rd}(avg(2.0 * abs({e}) / nullif(abs({y}) + abs({p}), 0.0)) * 100.0{", 6" if rounded else ""}) AS smape,
  {rd}(sum(abs({e})) / nullif(sum(abs({y})), 0.0) * 100.0{", 6" if rounded else ""}) AS wmape,
  {rd}(quantile_cont(abs({e}), 0.5){", 6" if rounded else ""}) AS mdae, {rd}(max(abs({e})){", 6" if rounded else ""}) AS max_error,
  {rd}(quantile_cont(abs({e}), 0.25){", 6" if rounded else ""}) AS q25_error, {rd}(quantile_cont(abs({e}), 0.75){", 6" if rounded else ""}) AS q75_error,
  {rd}(quantile_cont(abs({e}), 0.9){", 6" if rounded else ""}) AS q90_error,
  {rd}(CASE WHEN var_pop({y}) > 0 THEN 1.0 - var_pop({e}) / var_pop({y}) ELSE 0.0 END{", 6" if rounded else ""}) AS explained_variance
FROM {src} {'GROUP BY ' + g if by else ''}"""


@query("metrics", "WITH " + PRED_CTE + metrics_sql("y0", "p"))
def q_metrics(spark, sf):
    return normalize(ME.metrics(predictions(spark, sf), "y0", "p"))


@query("metrics_by_group", "WITH " + PRED_CTE + metrics_sql("y", "p", ("model", "fold")))
def q_metrics_by_group(spark, sf):
    return normalize(ME.metrics(predictions(spark, sf), "y", "p", by=["model", "fold"]))


# Line 7 has no prediction, so its group is empty: the constants of no rows.
def _empty_sql():
    groups = metrics_sql("y", "p", ("line",), src="(SELECT * FROM q WHERE p IS NOT NULL)")
    gone = ", ".join(f"CAST({v} AS DOUBLE) AS {m}" for m, v in zip(ME.METRICS, ["'inf'", "'inf'", "'-inf'", *["NULL"] * 9]))
    return (f"WITH {PRED_CTE}, q AS (SELECT CAST(l_linenumber AS BIGINT) AS line, y, CASE WHEN l_linenumber < 7 THEN p END AS p FROM pr)"
            f"{groups} UNION ALL BY NAME SELECT 7 AS line, 0 AS n, {gone}")


@query("metrics_empty_group", _empty_sql())
def q_metrics_empty(spark, sf):
    p = predictions(spark, sf).select(F.col("l_linenumber").cast("long").alias("line"), "y", F.when(F.col("l_linenumber") < 7, F.col("p")).alias("p"))
    return normalize(ME.metrics(p, "y", "p", by=["line"]))


def _avg_sql():
    inner = metrics_sql("y", "p", ("model", "fold"), rounded=False)
    cols = ", ".join(f"round(avg({m}), 6) AS {m}" for m in ME.METRICS)
    return f"WITH {PRED_CTE}, g AS ({inner}) SELECT model, {cols} FROM g GROUP BY model"


@query("metrics_avg", _avg_sql())
def q_metrics_avg(spark, sf):
    per = ME.metrics(predictions(spark, sf), "y", "p", by=["model", "fold"])
    return normalize(ME.metrics_average(per, ["model"]))


@query("melt_metrics", f"""
WITH {PRED_CTE}, g AS ({metrics_sql("y", "p", ("model", "fold"))}),
l AS (UNPIVOT g ON rmse, mae, r2 INTO NAME metric VALUE value)
SELECT model, fold, metric, value,
       row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END
                          ASC NULLS LAST, model, fold) AS rank
FROM l""")
def q_melt(spark, sf):
    per = normalize(ME.metrics(predictions(spark, sf), "y", "p", by=["model", "fold"]))
    return melt(per.select("model", "fold", "rmse", "mae", "r2"), ["model", "fold"], ["rmse", "mae", "r2"])


@query("best_model", f"""
WITH {PRED_CTE}, g AS ({metrics_sql("y", "p", ("model", "fold"))})
SELECT model, round(avg(rmse), 6) AS rmse FROM g GROUP BY model ORDER BY rmse, model LIMIT 1""")
def q_best(spark, sf):
    per = ME.metrics(predictions(spark, sf), "y", "p", by=["model", "fold"])
    avg = ME.metrics_average(per, ["model"])
    return normalize(avg.orderBy("rmse", "model").limit(1).select("model", "rmse"))


@query("fit_status", f"""
WITH {PRED_CTE}, g AS ({metrics_sql("y", "p", ("model", "fold"), rounded=False)})
SELECT tr.model, CASE WHEN (abs(tr.rmse - te.rmse) > 700 OR abs(tr.r2 - te.r2) > 0.1) AND tr.rmse - te.rmse < 0
                      THEN 'OVERFITTING'
                      WHEN abs(tr.rmse - te.rmse) > 700 OR abs(tr.r2 - te.r2) > 0.1 THEN 'UNDERFITTING'
                      ELSE 'GOOD_FIT' END AS fit_status
FROM g tr JOIN g te ON tr.model = te.model AND tr.fold = 'F' AND te.fold = 'O'""")
def q_fit_status(spark, sf):
    per = ME.metrics(predictions(spark, sf), "y", "p", by=["model", "fold"])
    tr = per.where(F.col("fold") == "F").select("model", F.col("rmse").alias("tr_rmse"), F.col("r2").alias("tr_r2"))
    te = per.where(F.col("fold") == "O").select("model", F.col("rmse").alias("te_rmse"), F.col("r2").alias("te_r2"))
    j = tr.join(te, "model")
    return j.select("model", ME.fit_status(F.col("tr_rmse"), F.col("te_rmse"), F.col("tr_r2"), F.col("te_r2"))
                    .alias("fit_status"))


@query("vote_combine", f"""
WITH {PRED_CTE} SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  round((p + y * 0.9 + (p + y) / 2.0) / 3.0, 6) AS vote FROM pr""")
def q_vote(spark, sf):
    from timewise.operators.models import vote
    pr = predictions(spark, sf).withColumns({"p2": F.col("y") * 0.9, "p3": (F.col("p") + F.col("y")) / 2.0})
    return normalize(vote(pr, ["p", "p2", "p3"]).select("l_orderkey", "l_linenumber", "vote"))
