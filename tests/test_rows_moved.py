"""How often a plan moves and keeps the rows, where tables are too large to broadcast."""
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from timewise.plans.fixtures import clean_sales, sales


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_move_twice_and_dedupe_moves_none(spark, sf, no_broadcast):
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, \d+\)", _plan(clean_sales(spark, sf)))
    assert sorted(keys) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]
    assert _plan(clean_sales(spark, sf)).count("Exchange hashpartitioning") == 6


def test_same_lines_in_either_order_of_joins(spark, sf, tmp_path):
    for t in ("lineitem", "orders", "part", "customer"):
        d = spark.read.parquet(f"{sf}/{t}.parquet").limit(400)
        d.union(d.limit(30)).write.parquet(str(tmp_path / f"{t}.parquet"))
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    orders.union(orders.limit(30)).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    kept = [sorted(map(str, f(spark, str(tmp_path)).collect())) for f in (sales, clean_sales)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert kept == [sorted(map(str, f(spark, str(tmp_path)).collect())) for f in (sales, clean_sales)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept[0]


def test_target_encode_orders_settled_rows(spark, sf):
    import timewise.plans.cache as cache
    from timewise.operators.encode import PastTargetEncoder
    s = cache.settled(clean_sales(spark, sf).select("l_orderkey", "l_linenumber", "saleDate", "targetPrice", "make_model"))
    assert cache._reads_settled(s.withColumn("z", F.col("targetPrice") + 1).where("z > 0"))
    assert not cache._reads_settled(s.groupBy("saleDate").count()) and not cache._reads_settled(clean_sales(spark, sf))
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    with cache.held(s):
        assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    out = PastTargetEncoder("make_model", tie=["l_orderkey", "l_linenumber"]).transform(s)
    assert out.count() == clean_sales(spark, sf).count()


def test_profile_joins_once(spark, sf, monkeypatch):
    import timewise.operators.profile as P
    seen, real = [], P.profile
    monkeypatch.setattr(P, "profile", lambda df, *a, **kw: seen.append(_plan(df)) or real(df, *a, **kw))
    entry.queries()["profile"](spark, sf).count()
    assert seen and not any("Join" in x for x in seen)


def test_filled_rows_are_cut_from_their_joins(spark, sf):
    from timewise.operators.select import filled_once
    with filled_once(clean_sales(spark, sf), ["kilometers", "cylinder"], "targetPrice") as data:
        assert "Join" not in _plan(data)


def test_fitted_pipeline_leaves_the_joins_behind(spark, sf):
    out = entry.queries()["preprocess_fit_transform"](spark, sf)
    assert "lineitem.parquet" not in " ".join(out.inputFiles()) and not spark.sparkContext._jsc.getPersistentRDDs()


def test_permutations_in_one_job_or_several(spark, monkeypatch):
    from pyspark.ml.regression import LinearRegression

    from timewise.operators import explain as EX
    from timewise.operators.models import assembler
    df = spark.createDataFrame([(float(i), float(i * 7 % 11), float(3 * i + i % 5)) for i in range(60)], "a double, b double, y double")
    m = LinearRegression(labelCol="y").fit(assembler(["a", "b"]).transform(df))
    got = []
    for most in (EX.MOVED_ROWS, 130, 1):
        monkeypatch.setattr(EX, "MOVED_ROWS", most)
        got.append({r["feature"]: (r["importance_mean"], r["importance_sd"]) for r in EX.permutation_importance(m, df, ["a", "b"], "y", repeats=5).collect()})
    assert got[0].keys() == {"a", "b"}
    for other in got[1:]:
        assert all(other[f] == pytest.approx(got[0][f]) for f in got[0])


def test_rfe_starts_from_known_scores(spark, monkeypatch):
    import timewise.operators.select as SE
    df = spark.createDataFrame([(float(i), float(i * 7 % 11), float(i * 5 % 13), float(2 * i + i % 3)) for i in range(80)], "a double, b double, c double, y double")
    first, made, real = SE.forest_scores(df, ["a", "b", "c"], "y", trees=4).collect(), [], SE.forest_scores
    monkeypatch.setattr(SE, "forest_scores", lambda *a, **kw: made.append(a[1]) or real(*a, **kw))
    plain = SE.rfe(df, ["a", "b", "c"], "y", 1, trees=4)
    assert [len(c) for c in made] == [3, 2]
    assert SE.rfe(df, ["a", "b", "c"], "y", 1, trees=4, first=first) == plain and [len(c) for c in made] == [3, 2, 2]


@pytest.mark.parametrize("name", ["sanitize", "final_impute"])
def test_joins_run_once_for_fit_and_result(spark, sf, name):
    out = entry.queries()[name](spark, sf)
    assert "Join" not in _plan(out) and out.count() == clean_sales(spark, sf).agg(F.count(F.lit(1))).first()[0]
