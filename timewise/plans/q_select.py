"""Registered queries for feature selection."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.functions.numeric import finite_frame
from timewise.operators import select as SE
from timewise.operators.folds import block_folds, time_index
from timewise.plans.cache import cut, held
from timewise.plans.common import normalize
from timewise.plans.fixtures import TIE_KEY, clean_sales, with_clean
from timewise.plans.registry import query
from timewise.session import read

FEATS = ["kilometers", "cubeCapacity", "cylinder", "powerKW", "powerHP", "vehicle_age_years", "km_per_year",
         "years_since_intro_at_sale", "doorNumber", "sale_month"]
Y = "targetPrice"


def _pairs_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {i} AS pa, corr({a}, {b}) AS r FROM st"
        for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j)


_POS = "VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATS))


@query("correlation_prune", with_clean(f"""
SELECT c.name AS "column", CAST(c.pos AS BIGINT) AS position, h.col_b IS NOT NULL AS dropped,
       h.because_of, round(h.r, 6) AS r
FROM ({_POS}) c(name, pos)
LEFT JOIN (SELECT col_b, arg_min(col_a, pa) AS because_of, arg_min(r, pa) AS r
           FROM ({_pairs_sql(FEATS)}) WHERE abs(r) > 0.8 GROUP BY col_b) h ON h.col_b = c.name"""))
def q_corr_prune(spark, sf):
    return normalize(SE.correlation_prune(clean_sales(spark, sf), FEATS, 0.8))


V3 = ["kilometers", "cylinder", "vehicle_age_years"]


def _gram_sql(cols, src="st"):
    """CTEs g0, g: the products of three columns, gaps filled with medians."""
    fills = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM {src})) AS {n}" for c, n in zip(cols, "xyz"))
    return (f"f AS (SELECT {fills} FROM {src})",
            "g0 AS (SELECT sum(x * x) AS aa, sum(x * y) AS ab, sum(x * z) AS ac, sum(y * y) AS bb, sum(y * z) AS bc, sum(z * z) AS cc FROM f)",
            "g AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM g0)")


@query("vif", with_clean("""
SELECT 'kilometers' AS "column", round(aa * (bb * cc - bc * bc) / det, 6) AS vif FROM g
UNION ALL SELECT 'cylinder', round(bb * (aa * cc - ac * ac) / det, 6) FROM g
UNION ALL SELECT 'vehicle_age_years', round(cc * (aa * bb - ab * ab) / det, 6) FROM g""", *_gram_sql(V3)))
def q_vif(spark, sf):
    return normalize(SE.vif(clean_sales(spark, sf), V3))


@query("vif_singular", """
SELECT 'quantity' AS "column", CAST('inf' AS DOUBLE) AS vif UNION ALL SELECT 'twice', CAST('inf' AS DOUBLE)
UNION ALL SELECT 'tax', round(1 / (1 - pow(sum(l_quantity * l_tax), 2) / (sum(l_quantity * l_quantity) * sum(l_tax * l_tax))), 6) FROM lineitem""")
def q_vif_singular(spark, sf):
    """Exact dependence: infinite for both columns, the third one untouched."""
    li = read(spark, sf, "lineitem").select(F.col("l_quantity").alias("quantity"), (2 * F.col("l_quantity")).alias("twice"),
                                            F.col("l_tax").alias("tax"))
    return normalize(SE.vif(li, ["quantity", "twice", "tax"]))


@query("vif_prune", """
WITH s AS (SELECT l_quantity AS x, l_quantity + 0.25 * l_tax * l_quantity AS y, l_discount + 1 AS z FROM lineitem),
g0 AS (SELECT sum(x * x) AS aa, sum(x * y) AS ab, sum(x * z) AS ac, sum(y * y) AS bb, sum(y * z) AS bc, sum(z * z) AS cc FROM s),
g AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM g0),
v AS (SELECT 'quantity' AS c, aa * (bb * cc - bc * bc) / det AS v FROM g UNION ALL SELECT 'taxed', bb * (aa * cc - ac * ac) / det FROM g
      UNION ALL SELECT 'kept', cc * (aa * bb - ab * ab) / det FROM g)
SELECT CAST(1 AS BIGINT) AS step, 'vif' AS rule, arg_max(c, v) AS "column", round(max(v), 3) AS value FROM v WHERE v > 10 HAVING count(*) > 0""")
def q_vif_prune(spark, sf):
    """Near dependence: the larger VIF of the pair goes, then all are small."""
    li = read(spark, sf, "lineitem").select(F.col("l_quantity").alias("quantity"), (F.col("l_discount") + 1).alias("kept"),
                                            (F.col("l_quantity") + 0.25 * F.col("l_tax") * F.col("l_quantity")).alias("taxed"))
    t = SE.vif_prune(li, ["quantity", "taxed", "kept"])
    return t.select("step", "rule", "column", F.round("value", 3).alias("value"))


def _f_sql(rounded=True):
    rd = "round" if rounded else ""
    dg = ", 6" if rounded else ""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position, regr_count({Y}, {c}) AS n, "
        f"{rd}(corr({c}, {Y}){dg}) AS r, {rd}(corr({c}, {Y}) * corr({c}, {Y}) / (1 - corr({c}, {Y}) * corr({c}, {Y})) "
        f"* (regr_count({Y}, {c}) - 2){dg}) AS f_score FROM st" for i, c in enumerate(FEATS))


@query("f_scores", with_clean(_f_sql()))
def q_f_scores(spark, sf):
    return normalize(SE.f_scores(clean_sales(spark, sf), FEATS, Y))


@query("select_k_best", with_clean(f"SELECT * FROM ({_f_sql()}) ORDER BY f_score DESC NULLS LAST, position LIMIT 4"))
def q_k_best(spark, sf):
    return normalize(SE.select_k_best(clean_sales(spark, sf), FEATS, Y, 4))


def _mi_sql(bins=10, rounded=True):
    pairs = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position, CAST({c} AS DOUBLE) AS x, {Y} AS y FROM st "
        f"WHERE {c} IS NOT NULL AND {Y} IS NOT NULL" for i, c in enumerate(FEATS))
    probs = "[" + ", ".join(f"{k / bins}" for k in range(1, bins)) + "]"
    return f"""
SELECT feature, {"round" if rounded else ""}(sum(nxy / n * ln(nxy * n / (nx * ny))){", 6" if rounded else ""}) AS mutual_info, any_value(position) AS position
FROM (SELECT *, sum(nxy) OVER (PARTITION BY feature, bx) AS nx, sum(nxy) OVER (PARTITION BY feature, by_) AS ny, sum(nxy) OVER (PARTITION BY feature) AS n
      FROM (SELECT feature, position, bx, by_, count(*) AS nxy
            FROM (SELECT p.feature, p.position, len(list_filter(ex, lambda e: e < x)) AS bx, len(list_filter(ey, lambda e: e < y)) AS by_
                  FROM ({pairs}) p
                  JOIN (SELECT feature, quantile_cont(x, {probs}) AS ex, quantile_cont(y, {probs}) AS ey FROM ({pairs}) GROUP BY feature) r USING (feature))
            GROUP BY feature, position, bx, by_))
GROUP BY feature"""


@query("mutual_info", with_clean(_mi_sql()))
def q_mi(spark, sf):
    return normalize(SE.mutual_info(clean_sales(spark, sf), FEATS, Y))


@query("rank_ensemble", with_clean(f"""
SELECT feature, round(avg(norm), 6) AS combined, min(position) AS position,
       row_number() OVER (ORDER BY avg(norm) DESC NULLS LAST, min(position)) AS rank
FROM (SELECT *, score / max(score) OVER (PARTITION BY method) AS norm FROM (
   SELECT 'f_test' AS method, feature, position, f_score AS score FROM ({_f_sql(False)})
   UNION ALL SELECT 'abs_corr', feature, position, abs(r) FROM ({_f_sql(False)})
   UNION ALL SELECT 'mutual_info', feature, position, mutual_info FROM ({_mi_sql(10, False)})))
GROUP BY feature QUALIFY rank <= 6"""))
def q_rank_ensemble(spark, sf):
    s = finite_frame(clean_sales(spark, sf), [*FEATS, Y])
    with held(s):                              # one pass for all scorers
        fs = SE.f_scores(s, FEATS, Y)
        rows = fs.collect()                    # one row per feature
        fs = spark.createDataFrame(rows, fs.schema)
        mi = SE.mutual_info(s, FEATS, Y)
    scores = (fs.select(F.lit("f_test").alias("method"), "feature", "position", F.col("f_score").alias("score"))
              .unionByName(fs.select(F.lit("abs_corr").alias("method"), "feature", "position",
                                     F.abs("r").alias("score")))
              .unionByName(mi.select(F.lit("mutual_info").alias("method"), "feature",
                                                             "position", F.col("mutual_info").alias("score"))))
    return normalize(SE.rank_ensemble(scores, 6))


def _folded(spark, sf):
    # only what the selectors read is put in order and checkpointed
    s = time_index(cut(clean_sales(spark, sf).select(*TIE_KEY, "saleDate", *FEATS, Y)), "saleDate", TIE_KEY)
    return block_folds(s, 5).withColumnRenamed("fold", "_fold")


@query("forest_scores")
def q_forest(spark, sf):
    return SE.forest_scores(clean_sales(spark, sf), FEATS, Y)


@query("lasso_scores")
def q_lasso(spark, sf):
    return SE.lasso_scores(_folded(spark, sf), FEATS, Y)


@query("backward_eliminate")
def q_backward(spark, sf):
    left = SE.backward_eliminate(_folded(spark, sf), FEATS, Y, 3, 8).features
    return spark.createDataFrame(list(enumerate(left)), "position long, feature string")


@query("select_features")
def q_select_features(spark, sf):
    left = SE.select_features(_folded(spark, sf), FEATS, Y).features
    return spark.createDataFrame(list(enumerate(left)), "position long, feature string")


@query("rfe")
def q_rfe(spark, sf):
    left = SE.rfe(clean_sales(spark, sf), FEATS, Y, k=6)
    return spark.createDataFrame(list(enumerate(left)), "position long, feature string")


@query("compare_selectors")
def q_compare(spark, sf):
    """The five best features by F score, recursive elimination, the ensemble
    of scorers and mean |attribution| of a linear model."""
    from pyspark.ml.regression import LinearRegression

    from timewise.operators.explain import attribution_rank, linear_attribution
    from timewise.operators.models import assembler
    s, k = _folded(spark, sf).persist(), 5
    x = SE.filled(s, FEATS, Y)
    coefs = LinearRegression(labelCol=Y).fit(assembler(FEATS).transform(x)).coefficients
    rows = x.withColumn("_row", F.lit(0))
    attribution = attribution_rank(linear_attribution(rows, dict(zip(FEATS, map(float, coefs))), ["_row"]), k).orderBy("rank")
    scores = SE.method_scores(s, FEATS, Y)
    found = scores.collect()                   # one row per method and feature
    scores, first = spark.createDataFrame(found, scores.schema), [r for r in found if r["method"] == "random_forest"]
    out = SE.compare_selectors({
        "f_score": [r["feature"] for r in SE.select_k_best(s, FEATS, Y, k).collect()],
        "rfe": SE.rfe(s, FEATS, Y, k, first=first),
        "ensemble": [r["feature"] for r in SE.rank_ensemble(scores, k).orderBy("rank").collect()],
        "attribution": [r["feature"] for r in attribution.collect()]})
    s.unpersist()
    return out


@query("remove_multicollinearity")
def q_remove_mc(spark, sf):
    """The removal table: correlation rule, then VIF rule (Gram matrix once, sub-matrices per step)."""
    _, gone = SE.remove_multicollinearity(clean_sales(spark, sf), FEATS, 0.8, 10.0)
    return gone
