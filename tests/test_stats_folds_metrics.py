import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from timewise.operators import folds as FO
from timewise.operators.metrics import metrics
from timewise.operators.sanitize import ColumnPruner, FinalImputer, NumericSanitizer, ColCfg
from timewise.operators.stats import quantiles
from timewise.plans.prefix import row_index, running_totals


def test_quantiles_exact_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (9.0,), (None,), (float("nan"),)], "x double")
    r = quantiles(df, ["x"], [0.5, 0.9, 0.25]).first()
    assert math.isclose(r["p90"], 7.2) and math.isclose(r["p50"], 2.5) and math.isclose(r["p25"], 1.75)


def test_quantiles_by_group_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 500), rng.normal(size=500))]
    df = spark.createDataFrame(rows, "g long, x double")
    got = {r["g"]: r["p75"] for r in quantiles(df, ["x"], [0.75], by=["g"]).collect()}
    for g in range(4):
        want = np.percentile([v for k, v in rows if k == g], 75)
        assert math.isclose(got[g], want, rel_tol=1e-12)


def test_running_totals_hot_group_and_many_blocks(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, g string, v double")
    out = running_totals(df, [F.col("i")], {"s": F.col("v")}, partition_by=["g"], n_blocks=16).collect()
    got = {r["i"]: r["s"] for r in out}
    acc = {}
    for i, g, v in rows:
        assert got[i] == acc.get(g, 0.0)
        acc[g] = acc.get(g, 0.0) + v


def test_no_single_partition_window_over_rows(spark):
    df = spark.range(100).withColumn("d", F.col("id") % 5)
    out = row_index(df, [F.col("d"), F.col("id")], "ix")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_time_folds_expanding_and_disjoint(spark):
    df = spark.range(103).withColumn("d", F.col("id"))
    ix = FO.time_index(df, "d", ["id"])
    t = FO.time_folds(ix, 3).collect()
    for f in range(3):
        tr = [r["row_idx"] for r in t if r["fold"] == f and r["role"] == "train"]
        te = [r["row_idx"] for r in t if r["fold"] == f and r["role"] == "test"]
        assert max(tr) < min(te) and len(te) == 103 // 4
    h = FO.holdout(ix, 0.2).where(F.col("role") == "test").count()
    assert h == math.ceil(0.2 * 103)
    bf = FO.block_folds(ix, 5).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in bf] == [21, 21, 21, 20, 20]


def test_metrics_match_numpy_and_repartition_invariant(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(100, 10, 200)
    p = y + rng.normal(0, 5, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    a = metrics(df, "y", "p").first()
    b = metrics(df.repartition(7), "y", "p").first()
    e = y - p
    assert math.isclose(a["rmse"], float(np.sqrt(np.mean(e * e))), rel_tol=1e-10)
    assert math.isclose(a["q90_error"], float(np.percentile(np.abs(e), 90)), rel_tol=1e-10)
    assert math.isclose(a["r2"], 1 - np.sum(e * e) / np.sum((y - y.mean()) ** 2), rel_tol=1e-9)
    for k in ("rmse", "mae", "r2", "mdae", "q25_error"):
        assert math.isclose(a[k], b[k], rel_tol=1e-9)


def test_metrics_empty_after_finite_filter(spark):
    df = spark.createDataFrame([("m", float("nan"), 1.0), ("m", float("inf"), 2.0)], "g string, y double, p double")
    r = metrics(df, "y", "p", by=["g"]).first()
    assert r["n"] == 0 and r["rmse"] == math.inf and r["r2"] == -math.inf


def test_sanitizer_and_imputer_and_pruner(spark):
    rows = [(1.0, 5.0, None, 7.0), (40.0, None, None, 7.0), (3.0, 2.0, None, 7.0), (None, 1.0, None, 7.0)]
    df = spark.createDataFrame(rows, "cyl double, km double, allnull double, const double")
    m = NumericSanitizer({"cyl": ColCfg(min_val=2, max_val=16)}).fit(df)
    out = [r["cyl"] for r in m.transform(df).collect()]
    assert out == [3.0, 3.0, 3.0, 3.0]  # median of raw values 1, 40, 3 is 3
    imp = FinalImputer(cols=["km"]).fit(df)
    assert [r["km"] for r in imp.transform(df).collect()] == [5.0, 2.0, 2.0, 1.0]
    pr = ColumnPruner().fit(df)
    assert sorted(pr.drop) == ["allnull", "const"]


def test_pruner_decided_at_fit_not_per_batch(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, c double")
    pr = ColumnPruner().fit(df)
    one = spark.createDataFrame([(5.0, 9.0)], "a double, c double")
    assert pr.transform(one).columns == ["a"]
