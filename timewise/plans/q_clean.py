"""Registered queries for cleaning operators."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.functions.text import clean_text, clean_text_sql
from timewise.operators import clean
from timewise.plans.common import KEY4, KEY4_SQL, normalize, r6
from timewise.plans.fixtures import sales, with_sales
from timewise.plans.registry import query
from timewise.session import read

_TXT_DATE = ("CASE WHEN l_linenumber IN (2, 4, 6) THEN strftime(saleDate, '%d/%m/%Y') "
             "WHEN l_linenumber = 5 THEN 'n/a' ELSE strftime(saleDate, '%Y-%m-%d') END")


@query("parse_dates", with_sales(f"""
SELECT {KEY4_SQL}, date_text,
       CAST(coalesce(try_strptime(date_text, '%d/%m/%Y'), try_strptime(date_text, '%Y-%m-%d')) AS DATE) AS saleDate
FROM (SELECT *, {_TXT_DATE} AS date_text FROM sales)"""))
def q_parse_dates(spark, sf):
    s = sales(spark, sf)
    txt = (F.when(F.col("l_linenumber").isin(2, 4, 6), F.date_format("saleDate", "dd/MM/yyyy"))
            .when(F.col("l_linenumber") == 5, F.lit("n/a"))
            .otherwise(F.date_format("saleDate", "yyyy-MM-dd")))
    t = s.select(*KEY4, txt.alias("date_text"), txt.alias("saleDate"))
    return normalize(clean.parse_dates(t, ["saleDate"]))


@query("dedupe", """
SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem""")
def q_dedupe(spark, sf):
    li = read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return normalize(clean.dedupe(li))


@query("to_number", with_sales(f"""
SELECT {KEY4_SQL}, TRY_CAST(trim(doorNumber) AS DOUBLE) AS doorNumber FROM sales"""))
def q_to_number(spark, sf):
    return normalize(clean.to_numbers(sales(spark, sf), ["doorNumber"]).select(*KEY4, "doorNumber"))


@query("chronology_guard", with_sales(f"""
SELECT {KEY4_SQL}, CAST(year(saleDate) AS BIGINT) AS sale_year,
       CASE WHEN yearIntroduced >= 1900 THEN yearIntroduced END AS yearIntroduced,
       round(CAST(year(saleDate) AS DOUBLE) - CASE WHEN yearIntroduced >= 1900 THEN yearIntroduced END, 6)
         AS years_since_intro_at_sale
FROM sales WHERE NOT coalesce(yearIntroduced > year(saleDate), false)"""))
def q_chronology_guard(spark, sf):
    g = clean.chronology_guard(sales(spark, sf))
    return normalize(g.select(*KEY4, "sale_year", "yearIntroduced", "years_since_intro_at_sale"))


@query("mask_nonpositive", with_sales(f"""
SELECT {KEY4_SQL}, CASE WHEN cubeCapacity > 0 THEN cubeCapacity END AS cubeCapacity FROM sales"""))
def q_mask_nonpositive(spark, sf):
    return normalize(clean.mask_nonpositive(sales(spark, sf)).select(*KEY4, "cubeCapacity"))


@query("date_parts", with_sales(f"""
SELECT {KEY4_SQL}, CAST(year(saleDate) AS BIGINT) AS sale_year, CAST(month(saleDate) AS BIGINT) AS sale_month
FROM sales"""))
def q_date_parts(spark, sf):
    return normalize(clean.date_parts(sales(spark, sf)).select(*KEY4, "sale_year", "sale_month"))


_AGE = "date_diff('day', registrationDate, saleDate) / 365.25"


@query("age_years", with_sales(f"""
SELECT {KEY4_SQL}, round({_AGE}, 6) AS vehicle_age_years FROM sales"""))
def q_age_years(spark, sf):
    return normalize(clean.age_and_rate(sales(spark, sf)).select(*KEY4, "vehicle_age_years"))


@query("safe_ratio", with_sales(f"""
SELECT {KEY4_SQL}, round(kilometers / nullif({_AGE}, 0.0), 6) AS km_per_year FROM sales"""))
def q_safe_ratio(spark, sf):
    return normalize(clean.age_and_rate(sales(spark, sf)).select(*KEY4, "km_per_year"))


@query("composite", with_sales(f"""
SELECT {KEY4_SQL}, make || '_' || model AS make_model FROM sales"""))
def q_composite(spark, sf):
    return normalize(clean.composite(sales(spark, sf)).select(*KEY4, "make_model"))


@query("clean_text", f"""
SELECT doc_id, {clean_text_sql('text')} AS text_clean FROM documents""")
def q_clean_text(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", clean_text("text").alias("text_clean"))


# Nation names carried over into other scripts and back by the normal form.
# Letters and characters of the fixture with their readings.
_CYR = dict(zip("abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстуvшжыз"))
_CYR_BACK = {"б": "b", "в": "v", "г": "g", "д": "d", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "п": "p", "т": "t",
             "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ш": "sh", "ы": "y", "я": "ia", "а": "a", "е": "e", "о": "o", "р": "r", "с": "s"}
_OTHER = [("東京", "dong jing"), ("Αθήνα", "athena"), ("Đà Nẵng", "da nang"), ("서울", "seoul"), ("北京大学", "bei jing da xue"), ("ひらがな", "hiragana"),
          ("Щёлково", "shchiolkovo"), ("ﬁn ＡＢ1", "fin ab1"), ("Gdańsk—Łódź", "gdansk lodz"), ("ქართული", "kartuli")]


def _scripts_sql():
    cyr = "array_to_string(list_transform(string_split(replace(lower(n_name), '_', ' '), ''), lambda x: CASE x " + " ".join(
        f"WHEN '{a}' THEN '{_CYR_BACK.get(b, b)}'" for a, b in _CYR.items()) + " ELSE x END), '')"
    other = "CASE n_nationkey % 10 " + " ".join(f"WHEN {i} THEN '{b}'" for i, (_, b) in enumerate(_OTHER)) + " END"
    return f"SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, {cyr} AS name_clean, {other} AS place_clean, {cyr} || ' ' || {other} AS both_clean FROM nation"


@query("clean_text_scripts", _scripts_sql())
def q_clean_scripts(spark, sf):
    n = read(spark, sf, "nation")
    name = F.translate(F.upper("n_name"), "".join(_CYR).upper(), "".join(_CYR.values()).upper())
    place = F.element_at(F.array(*[F.lit(a) for a, _ in _OTHER]), (F.col("n_nationkey") % 10 + 1).cast("int"))
    return normalize(n.select("n_nationkey", clean_text(name).alias("name_clean"), clean_text(place).alias("place_clean"),
                              clean_text(F.concat_ws(" / ", name, place)).alias("both_clean")))


@query("stateless_steps", with_sales(f"""
SELECT count(*) AS n_rows, count(DISTINCT make || '_' || model) AS n_make_model,
       CAST(sum(CASE WHEN doorNumber = 'n/a' THEN 1 ELSE 0 END) AS BIGINT) AS n_door_null,
       round(sum(date_diff('day', registrationDate, saleDate) / 365.25), 6) AS sum_age
FROM sales WHERE NOT coalesce(yearIntroduced > year(saleDate), false)"""))
def q_stateless_steps(spark, sf):
    s = clean.stateless_steps(sales(spark, sf))
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("make_model").alias("n_make_model"),
                 F.count_if(F.col("doorNumber").isNull()).cast("long").alias("n_door_null"),
                 r6(F.sum("vehicle_age_years")).alias("sum_age"))


# C13: the feature frame keeps every column but the target and the sale date.
@query("xy_split", with_sales("SELECT * EXCLUDE (targetPrice, saleDate) FROM sales"))
def q_xy_split(spark, sf):
    x, _ = clean.xy_split(sales(spark, sf), target="targetPrice", date="saleDate")
    return normalize(x)


# C14: a scoring request without a sale date is scored as of today.
@query("default_column", with_sales(f"""
SELECT {KEY4_SQL}, current_date AS saleDate,
       CAST(date_diff('day', registrationDate, current_date) AS BIGINT) AS age_days
FROM sales"""))
def q_default_column(spark, sf):
    req = sales(spark, sf).select(*KEY4, "registrationDate")
    req = clean.default_column(req, "saleDate")
    req = clean.default_column(req, "registrationDate", "1900-01-01")  # present: left as is
    return normalize(req.select(*KEY4, "saleDate",
                                F.datediff("saleDate", "registrationDate").cast("long").alias("age_days")))
