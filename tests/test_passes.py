"""How often the fits read their rows, and how wide the frames are that they hold."""
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from timewise.operators import explain as EX
from timewise.operators import profile as P
from timewise.operators import select as SE
from timewise.operators.encode import PastTargetEncoder
from timewise.operators.sanitize import ColCfg, NumericSanitizer
from timewise.plans import q_encode, q_profile, q_select


def counted(df):
    """``df`` and a counter of the rows that were read from it."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema), read


def _rows(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    rows = [(float(a), None if i % 9 == 0 else float(b), float(round(c)), float(2 * a + b), i % 4) for i, (a, b, c) in enumerate(x)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, _fold int").repartition(3)


@pytest.mark.parametrize("fit", [
    lambda df: SE.mutual_info(df, ["a", "b", "c"], "y").collect(),
    lambda df: NumericSanitizer({"a": ColCfg(0, None, "median"), "b": ColCfg(0, 1, "mean")}).fit(df)], ids=["mutual_info", "sanitize"])
def test_rows_are_read_once(spark, fit):
    df, read = counted(_rows(spark))
    fit(df)
    assert read.value == 400


def test_mutual_info_against_numpy(spark):
    df = _rows(spark)
    got = {r["feature"]: r["mutual_info"] for r in SE.mutual_info(df, ["a", "b", "c"], "y").collect()}
    rows = df.collect()
    for c in ("a", "b", "c"):
        x, y = np.array([(r[c], r["y"]) for r in rows if r[c] is not None and r["y"] is not None]).T
        at = [np.searchsorted(np.quantile(v, np.arange(1, 10) / 10), v, "left") for v in (x, y)]
        n = np.histogram2d(*at, bins=(range(11), range(11)))[0]
        p, px, py = n / n.sum(), n.sum(1, keepdims=True) / n.sum(), n.sum(0, keepdims=True) / n.sum()
        assert got[c] == pytest.approx((p[n > 0] * np.log((p / (px * py + 1e-300))[n > 0])).sum())


def test_mutual_info_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (2.0, None, 3.0)], "a double, b double, y double")
    assert [r["feature"] for r in SE.mutual_info(df, ["a", "b"], "y").collect()] == ["a"]
    assert SE.mutual_info(df.where("a > 9"), ["a", "b"], "y").collect() == []


@pytest.mark.parametrize("module, query", [(q_profile, "q_alerts"), (q_select, "q_rank_ensemble")])
def test_queries_clean_their_rows_once(spark, sf, monkeypatch, module, query):
    df, read = counted(module.clean_sales(spark, sf))
    n = df.count()
    read.value = 0
    monkeypatch.setattr(module, "clean_sales", lambda *_: df)
    assert getattr(module, query)(spark, sf).count() > 0
    assert read.value == n


def test_counts_of_levels_are_taken_once(spark):
    df, read = counted(spark.createDataFrame([("a", "x"), ("b", "y"), ("a", None)] * 5, "s string, t string"))
    P.level_balance(df, ["s", "t"]).collect()
    assert read.value == 15


def test_sanitizer_holds_its_own_columns(spark, monkeypatch):
    kind, wide = type(spark.range(1)), []
    persist = kind.persist
    monkeypatch.setattr(kind, "persist", lambda df, *a: (wide.append(df.columns), persist(df, *a))[1])
    NumericSanitizer({"a": ColCfg(0, None, "median")}).fit(_rows(spark))
    assert wide and all("y" not in columns for columns in wide)


def test_target_encode_orders_the_columns_it_needs(spark, sf, monkeypatch):
    seen, transform = [], PastTargetEncoder.transform
    monkeypatch.setattr(PastTargetEncoder, "transform", lambda self, df: (seen.append(df.columns), transform(self, df))[1])
    assert q_encode.q_target_encode(spark, sf).count() > 0
    assert "colour" not in seen[0] and "make_model" in seen[0]


def test_interactions_shuffle_an_id_once(spark, monkeypatch):
    wide, plain = [], EX.correlation
    monkeypatch.setattr(EX, "correlation", lambda df, cols: (wide.append(df), plain(df, cols))[1])
    df = spark.range(50).select(F.col("id"), (F.col("id") * 1.0).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 7 * 1.0).alias("b"))
    out = {(r["col_a"], r["col_b"]): r["r"] for r in EX.attribution_interactions(EX.linear_attribution(df, {"a": 1.0, "b": -2.0}, ["id"]), ["id"]).collect()}
    x, y = np.array([(i, -2.0 * (i % 7)) for i in range(50) if i % 7]).T
    assert out["a", "b"] == pytest.approx(np.corrcoef(x, y)[0, 1]) and out["a", "a"] == 0.0
    assert len(re.findall(r"Exchange hashpartitioning", wide[0]._jdf.queryExecution().sparkPlan().toString() + wide[0]._jdf.queryExecution().executedPlan().toString())) == 1
