"""Small helpers shared by the query modules."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def normalize(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, integral types as BIGINT."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            cols.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            cols.append(c.cast("long").alias(f.name))
        else:
            cols.append(c.alias(f.name))
    return df.select(*cols)


KEY4 = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY4_SQL = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey"
TIE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
