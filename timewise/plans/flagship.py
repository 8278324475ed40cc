"""The flagship query: the minimum slice of the cleaning flow."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timewise.operators import clean
from timewise.operators.encode import PastTargetEncoder
from timewise.plans.fixtures import TIE_KEY, sales
from timewise.session import ensure_checkpoint_dir


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    s = clean.stateless_steps(sales(spark, sf_dir))
    enc = PastTargetEncoder("make_model", tie=TIE_KEY, sum_scale=2).transform(s)
    return enc.select(*TIE_KEY, "saleDate", "sale_year", "vehicle_age_years", "km_per_year",
                      "years_since_intro_at_sale", "make_model", "targetPrice", "make_model__te")
