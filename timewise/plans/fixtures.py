"""The ``sales`` view: driver tables mapped onto the cleaning-flow schema.

lineitem joins orders, part and customer on their keys (one output row per
line).  The joins are plain equi-joins: Spark's size check decides broadcast
(small dimension) or sort-merge (large), and AQE revisits the choice at
run time, so nothing here forces a broadcast of a table that grows with the
data.  Where it will shuffle, the order of the joins is the one that moves the
lines twice; dedupe then finds equal lines in one place.  Nulls are injected by formula because the driver tables hold none.
The DuckDB text ``SALES_SQL`` computes the same columns for the oracle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timewise.session import read

TIE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]

# Ordinal maps for the two grade columns of the fixture
# (order priority as aesthetic grade, order status as mechanical grade;
# status 'P' is left unmapped on purpose).
AESTHETIC_MAP = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
MECHANICAL_MAP = {"F": 1, "O": 2}


def _may_broadcast(df: DataFrame) -> bool:
    """Spark's own size check, before the joins."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    if all(_may_broadcast(t) for t in (o, p, c)):
        j = (l.join(o, l.l_orderkey == o.o_orderkey)
              .join(p, l.l_partkey == p.p_partkey)
              .join(c, o.o_custkey == c.c_custkey))
    else:
        # shuffled: customers meet the orders, not the lines, and the lines end
        # up dealt by a column they keep, so that dedupe needs no exchange
        oc = o.join(c, o.o_custkey == c.c_custkey)
        j = l.join(oc, l.l_orderkey == oc.o_orderkey).join(p, l.l_partkey == p.p_partkey)
    power_kw = F.col("p_retailprice") - F.lit(850.0)
    return j.select(
        *TIE_KEY,
        F.to_date("l_shipdate").alias("saleDate"),
        F.to_date("o_orderdate").alias("registrationDate"),
        F.when(F.col("l_linenumber") == 7, F.lit(1800.0))
         .otherwise(F.year("o_orderdate").cast("double")).alias("yearIntroduced"),
        (F.nullif(F.col("l_quantity"), F.lit(50.0)) * F.lit(1000.0)).alias("kilometers"),
        F.when(F.col("p_size") <= 2, F.lit(0.0))
         .otherwise(F.col("p_size").cast("double") * F.lit(50.0)).alias("cubeCapacity"),
        F.col("l_linenumber").cast("double").alias("cylinder"),
        power_kw.alias("powerKW"),
        (F.lit(1.341) * power_kw + F.col("l_discount")).alias("powerHP"),
        F.when(F.col("l_linenumber") == 3, F.lit("n/a"))
         .otherwise(F.col("l_linenumber").cast("string")).alias("doorNumber"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("colour"),
        F.col("o_orderpriority").alias("aestheticGrade"),
        F.col("o_orderstatus").alias("mechanicalGrade"),
        F.col("p_type").alias("type"),
        F.col("l_returnflag").alias("fuel"),
        F.col("l_linestatus").alias("transmission"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        F.col("l_extendedprice").alias("targetPrice"),
    )


SALES_SQL = """
sales AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
         CAST(l_shipdate AS DATE) AS saleDate,
         CAST(o_orderdate AS DATE) AS registrationDate,
         CASE WHEN l_linenumber = 7 THEN 1800.0 ELSE CAST(year(o_orderdate) AS DOUBLE) END AS yearIntroduced,
         nullif(l_quantity, 50.0) * 1000.0 AS kilometers,
         CASE WHEN p_size <= 2 THEN 0.0 ELSE CAST(p_size AS DOUBLE) * 50.0 END AS cubeCapacity,
         CAST(l_linenumber AS DOUBLE) AS cylinder,
         p_retailprice - 850.0 AS powerKW,
         CAST(1.341 AS DOUBLE) * (p_retailprice - 850.0) + l_discount AS powerHP,
         CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END AS doorNumber,
         nullif(c_mktsegment, 'MACHINERY') AS colour,
         o_orderpriority AS aestheticGrade,
         o_orderstatus AS mechanicalGrade,
         p_type AS type,
         l_returnflag AS fuel,
         l_linestatus AS transmission,
         p_brand AS make,
         p_name AS model,
         l_extendedprice AS targetPrice
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""


def with_sales(sql_body: str, *ctes: str) -> str:
    """Prefix a DuckDB query with the ``sales`` view and further CTEs."""
    parts = [SALES_SQL.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + sql_body


def _clean_sql(e: str) -> str:
    from timewise.functions.text import clean_text_sql
    return clean_text_sql(e)


_AGE_SQL = "date_diff('day', registrationDate, saleDate) / 365.25"
_YI_SQL = "CASE WHEN yearIntroduced >= 1900 THEN yearIntroduced END"

# The ``st`` CTE: sales after the fixed cleaning steps (the SQL twin of
# ``timewise.operators.clean.stateless_steps``).
CLEAN_SQL = f"""
st AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, saleDate,
         {_YI_SQL} AS yearIntroduced,
         kilometers,
         CASE WHEN cubeCapacity > 0 THEN cubeCapacity END AS cubeCapacity,
         cylinder, powerKW, powerHP,
         TRY_CAST(trim(doorNumber) AS DOUBLE) AS doorNumber,
         {_clean_sql('colour')} AS colour,
         {_clean_sql('aestheticGrade')} AS aestheticGrade,
         {_clean_sql('mechanicalGrade')} AS mechanicalGrade,
         {_clean_sql('type')} AS type,
         {_clean_sql('fuel')} AS fuel,
         {_clean_sql('transmission')} AS transmission,
         targetPrice,
         year(saleDate) AS sale_year,
         CAST(year(saleDate) AS DOUBLE) - {_YI_SQL} AS years_since_intro_at_sale,
         month(saleDate) AS sale_month,
         {_AGE_SQL} AS vehicle_age_years,
         kilometers / nullif({_AGE_SQL}, 0.0) AS km_per_year,
         {_clean_sql("(make || '_' || model)")} AS make_model
  FROM sales WHERE NOT coalesce(yearIntroduced > year(saleDate), false)
)"""


def with_clean(sql_body: str, *ctes: str) -> str:
    return with_sales(sql_body, CLEAN_SQL, *ctes)


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timewise.operators.clean import stateless_steps
    return stateless_steps(sales(spark, sf_dir))
