"""Registered queries for profiling."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.operators import profile as P
from timewise.plans.cache import held, settled
from timewise.plans.common import KEY4, KEY4_SQL, normalize
from timewise.plans.fixtures import clean_sales, sales, with_clean, with_sales
from timewise.plans.registry import query
from timewise.session import read

SALES_KINDS = [
    ("l_orderkey", "numeric"), ("l_linenumber", "numeric"), ("l_partkey", "numeric"), ("l_suppkey", "numeric"),
    ("l_shipdate", "datetime"), ("l_extendedprice", "numeric"), ("saleDate", "datetime"),
    ("registrationDate", "datetime"), ("yearIntroduced", "numeric"), ("kilometers", "numeric"),
    ("cubeCapacity", "numeric"), ("cylinder", "numeric"), ("powerKW", "numeric"), ("powerHP", "numeric"),
    ("doorNumber", "string"), ("colour", "string"), ("aestheticGrade", "string"), ("mechanicalGrade", "string"),
    ("type", "string"), ("fuel", "string"), ("transmission", "string"), ("make", "string"), ("model", "string"),
    ("targetPrice", "numeric"),
]


@query("profile_info", with_sales(" UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{k}' AS kind, count({c}) AS non_null FROM sales"
    for i, (c, k) in enumerate(SALES_KINDS))))
def q_info(spark, sf):
    return P.info(sales(spark, sf)).drop("dtype")


@query("duplicate_count", """
SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus,
        l_linenumber FROM lineitem)) AS duplicates""")
def q_dups(spark, sf):
    return P.duplicate_count(read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


MISS = ["kilometers", "cubeCapacity", "doorNumber", "yearIntroduced", "colour", "km_per_year", "targetPrice"]


@query("missing_profile", with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
    f"round((count(*) - count({c})) / count(*) * 100.0, 6) AS pct_missing FROM st" for c in MISS)))
def q_missing(spark, sf):
    return normalize(P.missing_profile(clean_sales(spark, sf).select(*MISS)))


@query("missing_patterns", with_clean(
    "SELECT " + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in MISS)
    + " AS pattern, count(*) AS n_rows FROM st GROUP BY 1"))
def q_patterns(spark, sf):
    return P.missing_patterns(clean_sales(spark, sf).select(*MISS))


@query("moments", """
SELECT 'value' AS "column", count(v) AS n, round(avg(v), 6) AS mean, round(skewness(v), 6) AS skew,
       round(kurtosis(v), 6) AS kurtosis FROM (SELECT value + 1 AS v FROM events)
UNION ALL
SELECT 'n_chars', count(n_chars), round(avg(n_chars), 6), round(skewness(n_chars), 6), round(kurtosis(n_chars), 6)
FROM documents""")
def q_moments(spark, sf):
    ev = read(spark, sf, "events").select((F.col("value") + 1).alias("value"))
    docs = read(spark, sf, "documents")
    return normalize(P.moments(ev, ["value"]).unionByName(P.moments(docs, ["n_chars"])))


HIST = ["kilometers", "powerKW", "vehicle_age_years"]


def _hist_sql(c, bins=50):
    return f"""
SELECT '{c}' AS "column", CAST(g.bin AS BIGINT) AS bin, round(lo + g.bin * (hi - lo) / {float(bins)}, 6) AS bin_lo,
       round(lo + (g.bin + 1) * (hi - lo) / {float(bins)}, 6) AS bin_hi, coalesce(n, 0) AS count
FROM (SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo,
             CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi FROM st) r
CROSS JOIN range(0, {bins}) g(bin)
LEFT JOIN (SELECT least(CAST(floor(({c} - lo) * ({float(bins)} / (hi - lo))) AS BIGINT), {bins - 1}) AS b, count(*) AS n
           FROM st, (SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo,
                            CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi FROM st) r2
           WHERE {c} IS NOT NULL GROUP BY 1) h ON h.b = g.bin"""


@query("histogram", with_clean(" UNION ALL ".join(_hist_sql(c) for c in HIST)))
def q_hist(spark, sf):
    return normalize(P.histogram(clean_sales(spark, sf), HIST))


BOX = ["kilometers", "powerKW", "km_per_year"]


def _box_sql(c):
    return f"""
SELECT '{c}' AS "column", round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lo_fence, round(q3 + 1.5 * (q3 - q1), 6) AS hi_fence,
       round(min(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END), 6) AS whisker_lo,
       round(max(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END), 6) AS whisker_hi,
       count(CASE WHEN NOT ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) THEN 1 END) AS n_outliers
FROM st, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM st)
GROUP BY q1, med, q3"""


@query("box_stats", with_clean(" UNION ALL ".join(_box_sql(c) for c in BOX)))
def q_box(spark, sf):
    return normalize(P.box_stats(clean_sales(spark, sf), BOX))


CORR = ["kilometers", "cubeCapacity", "cylinder", "powerKW", "powerHP", "vehicle_age_years", "km_per_year",
        "targetPrice"]


def _corr_sql(cols):
    parts = []
    for a in cols:
        for b in cols:
            r = (f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0 END" if a == b else f"corr({a}, {b})")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({r}, 6) AS r FROM st")
    return " UNION ALL ".join(parts)


@query("correlation", with_clean(_corr_sql(CORR)))
def q_corr(spark, sf):
    return normalize(P.correlation(clean_sales(spark, sf), CORR))


TOP = ["colour", "type", "make_model", "aestheticGrade"]


@query("top_values", with_clean(f"""
SELECT "column", value, count, rank FROM (
  SELECT "column", value, count, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC) AS rank
  FROM (SELECT "column", value, count(*) AS count FROM (
          {' UNION ALL '.join(f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'Unknown') AS value FROM st" for c in TOP)})
        GROUP BY 1, 2))
WHERE rank <= 10"""))
def q_top(spark, sf):
    return P.top_values(clean_sales(spark, sf), TOP, 10)


@query("chronology_violations", with_sales(f"""
SELECT {KEY4_SQL}, coalesce(saleDate < make_date(CAST(yearIntroduced AS INTEGER), 1, 1), false) AS sold_before_intro,
       coalesce(registrationDate > saleDate, false) AS registered_after_sale
FROM sales WHERE coalesce(saleDate < make_date(CAST(yearIntroduced AS INTEGER), 1, 1), false)
              OR coalesce(registrationDate > saleDate, false)"""))
def q_chrono(spark, sf):
    v = P.chronology_violations(sales(spark, sf))
    return normalize(v.select(*KEY4, "sold_before_intro", "registered_after_sale"))


PROF_NUM = ["kilometers", "cubeCapacity", "targetPrice", "sale_month", "doorNumber"]
PROF_STR = ["colour", "fuel", "make_model"]


def _prof_sql():
    parts = []
    for c in PROF_NUM:
        parts.append(
            f"SELECT '{c}' AS \"column\", 'numeric' AS kind, count({c}) AS count, count(*) - count({c}) AS missing, "
            f"count(CASE WHEN {c} = 0 THEN 1 END) AS zeros, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
            f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, count(DISTINCT {c}) AS distinct, "
            f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            f"round(quantile_cont({c}, 0.75), 6) AS p75 FROM st")
    for c in PROF_STR:
        parts.append(
            f"SELECT '{c}', 'string', count({c}), count(*) - count({c}), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), "
            f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), count(DISTINCT {c}), "
            f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM st")
    return " UNION ALL ".join(parts)


@query("profile", with_clean(_prof_sql()))
def q_profile(spark, sf):
    s = settled(clean_sales(spark, sf).select(*PROF_NUM, *PROF_STR))      # read by totals, distinct counts and quartiles
    return normalize(P.profile(s))


BAL = ["colour", "aestheticGrade", "mechanicalGrade", "type", "fuel", "transmission", "make_model"]


ASSOC = ["colour", "fuel", "transmission", "make", "type"]


def _assoc_sql(cols=ASSOC, src="sales", rounded=True):
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN min({a}) < max({a}) THEN 1.0 END AS v FROM {src}")
                continue
            cells = f"(SELECT {a} AS x, {b} AS y, count(*) AS n FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)"
            v = "sqrt(greatest(0, sum(n * n / (nx * ny)) - 1.0) / nullif(least(count(DISTINCT x), count(DISTINCT y)) - 1, 0))"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {f'round({v}, 6)' if rounded else v} AS v FROM "
                         f"(SELECT x, y, CAST(n AS DOUBLE) AS n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM {cells})")
    return " UNION ALL ".join(parts)


@query("association", with_sales(_assoc_sql()))
def q_association(spark, sf):
    return normalize(P.association(sales(spark, sf), ASSOC))


def _alerts_sql():
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS \"column\", 'high_correlation:{b}' AS alert, round(corr({a}, {b}), 6) AS value FROM st "
        f"HAVING abs(corr({a}, {b})) > 0.9"
        for i, a in enumerate(CORR) for j, b in enumerate(CORR) if a < b)
    bal = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v FROM st" for c in BAL)
    imb = f"""
SELECT "column", 'imbalance', round(imb, 6) FROM (
  SELECT "column", CASE WHEN count(*) > 1 THEN 1.0 - sum(-(n / t) * ln(n / t)) / ln(count(*)) ELSE 0.0 END AS imb
  FROM (SELECT "column", v, count(*) AS n, sum(count(*)) OVER (PARTITION BY "column") AS t
        FROM ({bal}) WHERE v IS NOT NULL GROUP BY 1, 2) GROUP BY 1) WHERE imb > 0.5"""
    cols = CORR + BAL
    card = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{'string' if c in BAL else 'numeric'}' AS kind, count(DISTINCT {c}) AS d, "
        f"count({c}) AS n, count(*) - count({c}) AS m FROM st" for c in cols)
    rest = f"""
SELECT "column", 'high_cardinality', CAST(d AS DOUBLE) FROM ({card}) WHERE kind = 'string' AND d > 50
UNION ALL
SELECT "column", 'unique', CAST(d AS DOUBLE) FROM ({card}) WHERE d = n AND m = 0"""
    assoc = (f"SELECT col_a, 'high_correlation:' || col_b, round(v, 6) FROM ({_assoc_sql(BAL, 'st', False)}) WHERE col_a < col_b AND v > 0.9")
    return pairs + " UNION ALL " + imb + " UNION ALL " + rest + " UNION ALL " + assoc


@query("alerts", with_clean(_alerts_sql()))
def q_alerts(spark, sf):
    s = clean_sales(spark, sf).select(*CORR, *BAL)
    with held(s):                              # one pass for all statistics
        out = normalize(P.alerts(P.profile(s), P.correlation(s, CORR), P.level_balance(s, BAL), assoc_df=P.association(s, BAL)))
        rows = out.collect()                   # a few rows per column
    return spark.createDataFrame(rows, out.schema)


@query("sample_n", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity FROM lineitem
ORDER BY md5(concat_ws(':', 7, l_orderkey, l_linenumber, l_partkey)), l_orderkey, l_linenumber, l_partkey LIMIT 100""")
def q_sample(spark, sf):
    s = P.sample_n(read(spark, sf, "lineitem"), 100, seed=7, key=["l_orderkey", "l_linenumber", "l_partkey"])
    return normalize(s.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))


VER = ["l_orderkey", "saleDate", "kilometers", "cubeCapacity", "doorNumber", "colour", "fuel", "make_model",
       "targetPrice", "km_per_year"]


@query("verify", with_clean(
    "SELECT count(*) AS n_rows, CAST(10 AS BIGINT) AS n_cols, CAST(6 AS BIGINT) AS n_numeric, "
    "CAST(3 AS BIGINT) AS n_string, CAST(1 AS BIGINT) AS n_datetime, CAST(0 AS BIGINT) AS n_other, "
    "CAST(" + " + ".join(f"count(*) - count({c})" for c in VER) + " AS BIGINT) AS null_cells FROM st"))
def q_verify(spark, sf):
    return P.verify(clean_sales(spark, sf).select(*VER))
