"""Registered queries for categorical encoding."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.functions.text import clean_text, clean_text_sql
from timewise.operators.encode import (BinSpecs, OrdinalEncoder, PastTargetEncoder, TopShareOneHot,
                                       cardinality, level_shares)
from timewise.plans.cache import settled
from timewise.plans.common import KEY4, KEY4_SQL, normalize
from timewise.plans.fixtures import AESTHETIC_MAP, MECHANICAL_MAP, TIE_KEY, sales, with_sales
from timewise.plans.registry import query

CAT_COLS = ["colour", "aestheticGrade", "mechanicalGrade", "type", "fuel", "transmission", "make_model"]
MM_SQL = clean_text_sql("(make || '_' || model)")


def _cleaned_sales(spark, sf):
    s = sales(spark, sf)
    s = s.withColumn("make_model", F.concat("make", F.lit("_"), "model"))
    return s.withColumns({c: clean_text(c) for c in CAT_COLS})


def _cases(col, mapping):
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items()) + " END"


@query("ordinal_encode", with_sales(f"""
SELECT {KEY4_SQL}, CAST({_cases('aestheticGrade', AESTHETIC_MAP)} AS BIGINT) AS aestheticGrade_ordinal,
       CAST({_cases('mechanicalGrade', MECHANICAL_MAP)} AS BIGINT) AS mechanicalGrade_ordinal
FROM sales"""))
def q_ordinal(spark, sf):
    s = _cleaned_sales(spark, sf)
    s = OrdinalEncoder("aestheticGrade", AESTHETIC_MAP).transform(s)
    s = OrdinalEncoder("mechanicalGrade", MECHANICAL_MAP).transform(s)
    return normalize(s.select(*KEY4, "aestheticGrade_ordinal", "mechanicalGrade_ordinal"))


@query("bin_specs", with_sales(f"""
SELECT {KEY4_SQL},
       CAST(coalesce(type IN ('LARGE', 'MEDIUM'), false) AS BIGINT) AS type_big,
       CAST(coalesce(colour IN ('BUILDING', 'HOUSEHOLD'), false) AS BIGINT) AS colour_home
FROM sales"""))
def q_bin_specs(spark, sf):
    s = _cleaned_sales(spark, sf)
    s = BinSpecs("type", {"type_big": ["LARGE", "MEDIUM"]}).transform(s)
    s = BinSpecs("colour", {"colour_home": ["BUILDING", "HOUSEHOLD"]}).transform(s)
    return normalize(s.select(*KEY4, "type_big", "colour_home"))


_CARD_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {clean_text_sql(c if c != 'make_model' else '(make || ' + chr(39) + '_' + chr(39) + ' || model)')}) AS BIGINT) AS cardinality FROM sales"
    for c in CAT_COLS)


@query("category_cardinality", with_sales(_CARD_SQL))
def q_cardinality(spark, sf):
    return cardinality(_cleaned_sales(spark, sf), CAT_COLS)


def _levels_sql(col_expr: str, name: str, q: float) -> str:
    return f"""
SELECT '{name}' AS "column", level, n, round(n / total, 6) AS share, cum_n, rank,
       (cum_n <= {q} * total) OR (rank = 1 AND NOT max(cum_n <= {q} * total) OVER ()) AS kept,
       (nn_rank = 1 AND level IS NOT NULL) AS baseline
FROM (SELECT level, n, sum(n) OVER () AS total,
             sum(n) OVER (ORDER BY n DESC, level ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_n,
             row_number() OVER (ORDER BY n DESC, level ASC NULLS LAST) AS rank,
             row_number() OVER (ORDER BY level IS NULL, n DESC, level ASC NULLS LAST) AS nn_rank
      FROM (SELECT {col_expr} AS level, count(*) AS n FROM sales GROUP BY 1))"""


LEVEL_CASES = [("colour", 1.0), ("type", 0.7), ("make_model", 0.7)]


def _col_sql(c):
    return MM_SQL if c == "make_model" else clean_text_sql(c)


@query("onehot_levels", with_sales(" UNION ALL ".join(_levels_sql(_col_sql(c), c, q) for c, q in LEVEL_CASES)))
def q_onehot_levels(spark, sf):
    s = _cleaned_sales(spark, sf)
    out = None
    for c, q in LEVEL_CASES:
        t = level_shares(s, c, q).select(F.lit(c).alias("column"), "*")
        out = t if out is None else out.unionByName(t)
    return normalize(out)


@query("onehot", with_sales(f"""
SELECT {KEY4_SQL}, 'colour__' || k.level AS feature, CAST(coalesce(s.lvl = k.level, false) AS BIGINT) AS value
FROM (SELECT *, {clean_text_sql('colour')} AS lvl FROM sales) s
CROSS JOIN (SELECT level FROM ({_levels_sql(clean_text_sql('colour'), 'colour', 1.0)})
            WHERE kept AND NOT baseline AND level IS NOT NULL) k"""))
def q_onehot(spark, sf):
    s = _cleaned_sales(spark, sf)
    model = TopShareOneHot("colour", 1.0).fit(s)
    t = model.transform(s)
    feats = [f"colour__{lvl}" for lvl in model.levels]
    long = t.select(*KEY4, *[F.col(f"`{f}`").alias(f) for f in feats]).unpivot(KEY4, feats, "feature", "value")
    return normalize(long)


def _te_sql(frame_order: str) -> str:
    w_all = f"ORDER BY {frame_order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    w_cat = f"PARTITION BY mm {w_all}"
    return with_sales(f"""
SELECT {KEY4_SQL}, round(CASE WHEN mm IS NULL THEN NULL WHEN n_cat = 0 THEN 0.0 WHEN targetPrice IS NULL THEN NULL
        ELSE (CAST(s_cat AS DOUBLE) + 10.0 * (CASE WHEN c_all > 0 THEN CAST(s_all AS DOUBLE) / c_all ELSE 0.0 END))
             / (n_cat + 10.0) END, 6) AS make_model__te
FROM (SELECT *, coalesce(sum(y) OVER ({w_all}), 0) AS s_all, count(y) OVER ({w_all}) AS c_all,
             coalesce(sum(y) OVER ({w_cat}), 0) AS s_cat, count(*) OVER ({w_cat}) AS n_cat
      FROM (SELECT *, {MM_SQL} AS mm, CAST(targetPrice AS DECIMAL(18,2)) AS y FROM sales))""")


@query("target_encode", _te_sql("saleDate ASC NULLS LAST, " + ", ".join(TIE_KEY)))
def q_target_encode(spark, sf):
    # every row, with the columns that the encoder and the result take
    s = settled(_cleaned_sales(spark, sf).select(*TIE_KEY, "saleDate", "targetPrice", "make_model"))
    enc = PastTargetEncoder("make_model", tie=TIE_KEY, sum_scale=2).transform(s)
    return normalize(enc.select(*KEY4, "make_model__te"))


@query("target_encode_strict", with_sales(f"""
SELECT {KEY4_SQL}, round(CASE WHEN b.mm IS NULL THEN NULL WHEN n_cat = 0 THEN 0.0 WHEN targetPrice IS NULL THEN NULL
        ELSE (CAST(s_cat AS DOUBLE) + 10.0 * (CASE WHEN c_all > 0 THEN CAST(s_all AS DOUBLE) / c_all ELSE 0.0 END))
             / (n_cat + 10.0) END, 6) AS make_model__te
FROM b
JOIN (SELECT mm, saleDate,
             coalesce(sum(s) OVER (PARTITION BY mm ORDER BY saleDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s_cat,
             coalesce(sum(n) OVER (PARTITION BY mm ORDER BY saleDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_cat
      FROM (SELECT mm, saleDate, sum(y) AS s, count(*) AS n FROM b GROUP BY mm, saleDate)) cd USING (mm, saleDate)
JOIN (SELECT saleDate,
             coalesce(sum(s) OVER (ORDER BY saleDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s_all,
             coalesce(sum(c) OVER (ORDER BY saleDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_all
      FROM (SELECT saleDate, sum(y) AS s, count(y) AS c FROM b GROUP BY saleDate)) dd USING (saleDate)""",
    f"b AS (SELECT *, {MM_SQL} AS mm, CAST(targetPrice AS DECIMAL(18,2)) AS y FROM sales)"))
def q_target_encode_strict(spark, sf):
    s = _cleaned_sales(spark, sf)
    enc = PastTargetEncoder("make_model", tie=TIE_KEY, sum_scale=2, same_day="exclude").transform(s)
    return normalize(enc.select(*KEY4, "make_model__te"))


CUT = "1999-01-01"


@query("target_encode_score", with_sales(f"""
SELECT {KEY4_SQL}, round(CASE WHEN st.cnt IS NULL THEN p.prior ELSE (st.s + 10.0 * p.prior) / (st.cnt + 10.0) END, 6)
       AS make_model__te
FROM (SELECT * FROM b WHERE saleDate >= DATE '{CUT}') t
LEFT JOIN (SELECT mm, CAST(sum(y) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS cnt FROM b
           WHERE saleDate < DATE '{CUT}' AND mm IS NOT NULL GROUP BY mm) st ON t.mm = st.mm
CROSS JOIN (SELECT CAST(sum(y) AS DOUBLE) / count(y) AS prior FROM b WHERE saleDate < DATE '{CUT}') p""",
    f"b AS (SELECT *, {MM_SQL} AS mm, CAST(targetPrice AS DECIMAL(18,2)) AS y FROM sales)"))
def q_target_encode_score(spark, sf):
    s = _cleaned_sales(spark, sf)
    train = s.where(F.col("saleDate") < F.lit(CUT).cast("date"))
    test = s.where(F.col("saleDate") >= F.lit(CUT).cast("date"))
    model = PastTargetEncoder("make_model", tie=TIE_KEY, sum_scale=2).fit(train)
    return normalize(model.transform(test).select(*KEY4, "make_model__te"))
