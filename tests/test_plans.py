"""Plan shape checks for the scale properties the README claims."""
import re

from pyspark.sql import functions as F

from timewise.operators.profile import correlation
from timewise.plans.fixtures import sales


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_joins_force_no_exchange_and_scans_are_pruned(spark, sf):
    s = sales(spark, sf)
    assert "REPARTITION" not in _plan(s)
    formatted = s._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    li = [b for b in formatted.split("\n\n") if "lineitem.parquet" in b][0]
    schema = re.search(r"ReadSchema: struct<(.*)>", li).group(1)
    # ten of the sixteen lineitem columns are used; the rest are never read
    assert "l_comment" not in schema and "l_shipmode" not in schema
    assert "IsNotNull(l_orderkey)" in li


def test_correlation_one_pair_aggregate_no_single_partition(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("a"),
                                  (F.col("id") * 2.0 + 1.0).alias("b"),
                                  (F.col("id") % 7).cast("double").alias("c"))
    c = correlation(df, ["a", "b", "c"])
    plan = _plan(c)
    assert "SinglePartition" not in plan
    assert "Union" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(col_a", plan)) == 1
    got = {(r["col_a"], r["col_b"]): r["r"] for r in c.collect()}
    assert len(got) == 9
    assert abs(got[("a", "b")] - 1.0) < 1e-12 and got[("b", "a")] == got[("a", "b")]
    assert got[("c", "c")] == 1.0


def test_quantiles_order_value_counts_not_rows(spark):
    """A column of 60 % one value: what is ordered and checkpointed is one
    row per distinct value."""
    import timewise.operators.stats as stats
    seen = []
    real = stats.running_totals

    def spy(df, *a, **k):
        seen.append(df)
        return real(df, *a, **k)

    df = spark.range(20_000).select(F.when(F.col("id") % 5 < 3, 0.0).otherwise(F.col("id").cast("double")).alias("x"))
    stats.running_totals = spy
    try:
        row = stats.quantiles(df, ["x"], [0.5, 0.9]).first()
    finally:
        stats.running_totals = real
    assert row["p50"] == 0.0
    (counts,) = seen
    assert "HashAggregate" in _plan(counts) and counts.count() == 8_001
    assert counts.agg(F.sum("_c")).first()[0] == 20_000
