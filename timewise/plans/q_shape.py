"""Registered queries for distribution transforms."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.functions.numeric import yeo_johnson, yeo_johnson_inverse
from timewise.operators import shape as SH
from timewise.plans.common import KEY4, KEY4_SQL, normalize
from timewise.plans.fixtures import clean_sales, with_clean
from timewise.plans.registry import query
from timewise.session import read


def yj_sql(x: str, lam: float) -> str:
    pos = f"ln(1 + {x})" if abs(lam) < 1e-12 else f"(pow({x} + 1.0, {lam}) - 1.0) / {lam}"
    neg = f"-ln(1 - {x})" if abs(lam - 2) < 1e-12 else f"-(pow(1.0 - {x}, {2.0 - lam}) - 1.0) / {2.0 - lam}"
    return f"CASE WHEN {x} >= 0 THEN {pos} WHEN {x} < 0 THEN {neg} END"


def yj_inv_sql(y: str, lam: float) -> str:
    pos = f"exp({y}) - 1" if abs(lam) < 1e-12 else \
        f"CASE WHEN {y} * {lam} + 1.0 > 0 THEN pow({y} * {lam} + 1.0, {1.0 / lam}) - 1.0 END"
    neg = f"1.0 - exp(-{y})" if abs(lam - 2) < 1e-12 else \
        f"CASE WHEN 1.0 - {2.0 - lam} * {y} > 0 THEN 1.0 - pow(1.0 - {2.0 - lam} * {y}, {1.0 / (2.0 - lam)}) END"
    return f"CASE WHEN {y} >= 0 THEN {pos} WHEN {y} < 0 THEN {neg} END"


@query("target_transform", """
SELECT 'events_value' AS source, round(skewness(v), 6) AS skew, round(min(v), 6) AS min,
       coalesce(skewness(v) > 1.0 AND min(v) > 0, false) AS transform FROM (SELECT value + 1 AS v FROM events)
UNION ALL
SELECT 'extendedprice', round(skewness(l_extendedprice), 6), round(min(l_extendedprice), 6),
       coalesce(skewness(l_extendedprice) > 1.0 AND min(l_extendedprice) > 0, false) FROM lineitem""")
def q_target_transform(spark, sf):
    ev = read(spark, sf, "events").select((F.col("value") + 1).alias("v"))
    li = read(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("v"))
    rows = []
    for name, df in [("events_value", ev), ("extendedprice", li)]:
        sk, mn = SH.TargetTransform("v").decide(df)
        rows.append((name, sk, mn, bool(sk is not None and sk > 1.0 and mn is not None and mn > 0)))
    return normalize(spark.createDataFrame(rows, "source string, skew double, min double, transform boolean"))


LAMBDAS = [-1.0, -0.5, 0.0, 0.2, 0.5, 1.0, 1.5, 2.0, 2.5]


def _ll_sql(src: str, x: str, name: str):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS source, CAST({l} AS DOUBLE) AS lambda, round(-count({x}) / 2.0 * ln(var_pop({yj_sql(x, l)})) + "
        f"({l} - 1.0) * sum(sign({x}) * ln(1 + abs({x}))), 6) AS loglik FROM {src}" for l in LAMBDAS)


def _lambda_sql(x: str, name: str) -> str:
    """The lambda of largest likelihood by halving a bracket on the sign of a
    central difference, to about 1e-8."""
    def ll(lam):
        pos = f"CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {x}) ELSE (pow({x} + 1.0, {lam}) - 1.0) / ({lam}) END"
        neg = f"CASE WHEN abs({lam} - 2) < 1e-12 THEN -ln(1 - {x}) ELSE -(pow(1.0 - {x}, 2.0 - ({lam})) - 1.0) / (2.0 - ({lam})) END"
        return f"(-count({x}) / 2.0 * ln(var_pop(CASE WHEN {x} >= 0 THEN {pos} ELSE {neg} END)) + ({lam} - 1.0) * sum(sign({x}) * ln(1 + abs({x}))))"
    mid = "((lo + hi) / 2)"
    return f"""
(WITH RECURSIVE b(i, lo, hi) AS (SELECT 0, CAST(-3.0 AS DOUBLE), CAST(5.0 AS DOUBLE) UNION ALL
 SELECT i + 1, CASE WHEN up THEN {mid} ELSE lo END, CASE WHEN up THEN hi ELSE {mid} END
 FROM (SELECT i, lo, hi, {ll(f"({mid} + 1e-4)")} > {ll(f"({mid} - 1e-4)")} AS up FROM b, ev WHERE i < 30 GROUP BY i, lo, hi))
SELECT '{name}' AS source, round({mid}, 5) AS lambda FROM b ORDER BY i DESC LIMIT 1)"""


@query("yj_lambda", "WITH ev AS (SELECT value + 1 AS v, value - 50.0 AS w FROM events) SELECT * FROM "
       + _lambda_sql("v", "shifted_up") + " UNION ALL SELECT * FROM " + _lambda_sql("w", "shifted_down"))
def q_yj_lambda(spark, sf):
    ev = read(spark, sf, "events").select((F.col("value") + 1).alias("shifted_up"), (F.col("value") - 50.0).alias("shifted_down"))
    got = SH.fit_lambdas(ev, ["shifted_up", "shifted_down"])
    return normalize(spark.createDataFrame([(k, round(v, 5)) for k, v in got.items()], "source string, lambda double"))


@query("yj_likelihood",
       "WITH ev AS (SELECT value + 1 AS v, value - 50.0 AS w FROM events) "
       + _ll_sql("ev", "v", "shifted_up") + " UNION ALL " + _ll_sql("ev", "w", "shifted_down"))
def q_yj_ll(spark, sf):
    ev = read(spark, sf, "events").select((F.col("value") + 1).alias("v"), (F.col("value") - 50.0).alias("w"))
    a = SH.yj_loglik(ev, "v", LAMBDAS).select(F.lit("shifted_up").alias("source"), "*")
    b = SH.yj_loglik(ev, "w", LAMBDAS).select(F.lit("shifted_down").alias("source"), "*")
    return normalize(a.unionByName(b))


@query("yj_roundtrip", f"""
SELECT event_id, round(x, 6) AS x, round({yj_sql('x', 0.3)}, 6) AS yj,
       round({yj_inv_sql('(' + yj_sql('x', 0.3) + ')', 0.3)}, 6) AS back
FROM (SELECT event_id, value - 50.0 AS x FROM events)""")
def q_yj_roundtrip(spark, sf):
    ev = read(spark, sf, "events").select("event_id", (F.col("value") - 50.0).alias("x"))
    return normalize(ev.select("event_id", "x", yeo_johnson("x", 0.3).alias("yj"),
                               yeo_johnson_inverse(yeo_johnson("x", 0.3), 0.3).alias("back")))


@query("binary_columns", """
SELECT 'quality' AS "column", coalesce(bool_and(quality IN (0, 1)), true) AS is_binary FROM labels
UNION ALL SELECT 'toxic', coalesce(bool_and(toxic IN (0, 1)), true) FROM labels
UNION ALL SELECT 'doc_id', coalesce(bool_and(doc_id IN (0, 1)), true) FROM labels""")
def q_binary(spark, sf):
    return SH.binary_columns(read(spark, sf, "labels"), ["quality", "toxic", "doc_id"])


SKEW = ["kilometers", "cubeCapacity", "powerKW", "vehicle_age_years", "km_per_year", "targetPrice", "doorNumber"]


@query("skew_features", with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(bool_and({c} IN (0, 1)), true) AS is_binary, round(skewness({c}), 6) AS skew, "
    f"round(min({c}), 6) AS min, CASE WHEN NOT coalesce(bool_and({c} IN (0, 1)), true) AND coalesce(abs(skewness({c})) > 1.0, false) "
    f"THEN CASE WHEN min({c}) > 0 THEN 'log' ELSE 'yeo_johnson' END ELSE 'none' END AS action FROM st" for c in SKEW)))
def q_skew(spark, sf):
    return normalize(SH.SkewFeatures(cols=SKEW).decisions(clean_sales(spark, sf)))


SCALE = ["kilometers", "powerKW", "cylinder", "targetPrice"]


@query("standard_scale", with_clean(
    f"SELECT {KEY4_SQL}, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS {c}" for c in SCALE)
    + " FROM st, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE) + " FROM st)"))
def q_scale(spark, sf):
    s = clean_sales(spark, sf).select(*KEY4, *SCALE)
    return normalize(SH.StandardScale(cols=SCALE).fit(s).transform(s))
