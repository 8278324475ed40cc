"""Registered queries for sanitizing and pruning."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.operators.sanitize import (DEFAULT_NUMERIC_CFG, ColumnPruner, FinalImputer, NumericSanitizer,
                                         ZScore)
from timewise.plans.cache import settled
from timewise.plans.common import KEY4, KEY4_SQL, normalize, r6
from timewise.plans.fixtures import clean_sales, with_clean
from timewise.plans.registry import query

NUM = list(DEFAULT_NUMERIC_CFG)


@query("sanitize_stats", with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS median, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std FROM st" for c in NUM)))
def q_sanitize_stats(spark, sf):
    m = NumericSanitizer().fit(clean_sales(spark, sf))
    rows = [(c, s["median"], s["mean"], s["std"]) for c, s in m.stats.items()]
    df = spark.createDataFrame(rows, "column string, median double, mean double, std double")
    return normalize(df)


def _mask_sql(c):
    cfg = DEFAULT_NUMERIC_CFG[c]
    conds = []
    if cfg.min_val is not None:
        conds.append(f"{c} < {float(cfg.min_val)}")
    if cfg.max_val is not None:
        conds.append(f"{c} > {float(cfg.max_val)}")
    masked = f"CASE WHEN {' OR '.join(conds)} THEN NULL ELSE {c} END" if conds else c
    return f"coalesce({masked}, med_{c})"


_MED_CTE = "med AS (SELECT " + ", ".join(f"median({c}) AS med_{c}" for c in NUM) + " FROM st)"


@query("sanitize", with_clean(
    f"SELECT {KEY4_SQL}, " + ", ".join(f"round({_mask_sql(c)}, 6) AS {c}" for c in NUM) + " FROM st, med",
    _MED_CTE))
def q_sanitize(spark, sf):
    s = settled(clean_sales(spark, sf).select(*KEY4, *NUM))       # read by the fit and by the result
    out = NumericSanitizer().fit(s).transform(s)
    return normalize(out.select(*KEY4, *NUM))


_IMP = ["km_per_year", "doorNumber", "yearIntroduced"]


@query("final_impute", with_clean(
    f"SELECT {KEY4_SQL}, " + ", ".join(f"round(coalesce(x.{c}, m.{c}), 6) AS {c}" for c in _IMP)
    + " FROM x, (SELECT " + ", ".join(f"median({c}) AS {c}" for c in _IMP) + " FROM x) m",
    _MED_CTE,
    "x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, doorNumber, yearIntroduced, "
    "coalesce(CASE WHEN kilometers < 0 THEN NULL ELSE kilometers END, med_kilometers) / "
    "nullif(coalesce(CASE WHEN vehicle_age_years < 0 THEN NULL ELSE vehicle_age_years END, med_vehicle_age_years), 0.0)"
    " AS km_per_year FROM st, med)"))
def q_final_impute(spark, sf):
    s = settled(clean_sales(spark, sf).select(*KEY4, *dict.fromkeys([*NUM, *_IMP])))
    s = NumericSanitizer().fit(s).transform(s)
    s = s.withColumn("km_per_year", F.try_divide(F.col("kilometers"), F.nullif(F.col("vehicle_age_years"), F.lit(0.0))))
    x = s.select(*KEY4, *_IMP)
    return normalize(FinalImputer(cols=_IMP).fit(x).transform(x))


_PRUNE_COLS = ["yearIntroduced", "kilometers", "cubeCapacity", "doorNumber", "colour", "fuel", "transmission",
               "sale_year", "targetPrice"]


@query("prune_columns", with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count({c}) = 0 AS all_null, "
    f"(count({c}) = 0) OR (count({c}) = count(*) AND min({c}) = max({c})) AS constant FROM st"
    for c in _PRUNE_COLS)))
def q_prune(spark, sf):
    s = clean_sales(spark, sf).select(*_PRUNE_COLS)
    return normalize(ColumnPruner().decisions(s))


_Z = ["kilometers", "powerKW", "cylinder", "vehicle_age_years"]


@query("zscore", with_clean(
    f"SELECT {KEY4_SQL}, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS {c}" for c in _Z)
    + " FROM st, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _Z) + " FROM st)"))
def q_zscore(spark, sf):
    s = clean_sales(spark, sf).select(*KEY4, *_Z)
    return normalize(ZScore(cols=_Z).fit(s).transform(s))
