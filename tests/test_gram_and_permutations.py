"""Blocked cross products, association, Newton lambda and keyed bijections."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from timewise.operators import explain as EX
from timewise.operators import profile as P
from timewise.operators import shape as SH
from timewise.operators.gram import correlations, cross_products


@pytest.mark.parametrize("n", [1, 2, 3, 7, 48, 49, 50, 1000, 4097])
def test_partner_is_a_bijection(spark, n):
    turns = spark.range(3).withColumnRenamed("id", "r")
    got = spark.range(n).crossJoin(turns).select("r", "id", EX.partner(F.col("id"), n, F.lit(5), F.col("r")).alias("j")).collect()
    places = {r: sorted(g.j for g in got if g.r == r) for r in range(3)}
    assert all(p == list(range(n)) for p in places.values())
    if n >= 48:
        moved = [[g.j for g in sorted(got, key=lambda g: g.id) if g.r == r] for r in range(3)]
        assert moved[0] != moved[1] and sum(a == b for a, b in zip(moved[0], range(n))) < n / 4
        assert abs(np.corrcoef(moved[0], range(n))[0, 1]) < 0.5


def wide(spark, n, p, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, p)) * 10.0 ** r.integers(-2, 3, p) + 1e5
    names = [f"c{i}" for i in range(p)]
    return x, spark.createDataFrame([tuple(map(float, a)) for a in x], ", ".join(f"{c} double" for c in names)), names


def test_cross_products_of_500_columns(spark):
    x, df, names = wide(spark, 60, 500)
    got = cross_products(df.repartition(3), names)[None]
    assert np.allclose(got, x.T @ x)
    assert np.allclose(correlations(df, names[:30]), np.corrcoef(x[:, :30].T), atol=1e-6)


def test_cross_products_by_group_and_gaps(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(90, 3))
    x[r.random(x.shape) < 0.2] = np.nan
    rows = [(int(i % 3), *[None if np.isnan(v) else float(v) for v in a]) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    got = cross_products(df, ["a", "b", "c"], by="k")
    z = np.nan_to_num(x)
    assert set(got) == {0, 1, 2} and all(np.allclose(got[k], z[k::3].T @ z[k::3]) for k in got)
    r_ab = correlations(df, ["a", "b", "c"])
    both = ~np.isnan(x[:, 0]) & ~np.isnan(x[:, 1])
    assert np.isclose(r_ab[0, 1], np.corrcoef(x[both, 0], x[both, 1])[0, 1])
    assert cross_products(df.limit(0), ["a", "b"]) == {}
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert {(q.col_a, q.col_b): q.r for q in P.correlation(flat, ["a", "b"]).collect()} == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0}


def test_association(spark):
    rows = [("x", "1", "p", None), ("x", "1", "q", "u"), ("y", "2", "p", "v"), ("y", "2", "q", None)] * 5
    got = {(r.col_a, r.col_b): r.v for r in P.association(spark.createDataFrame(rows, "a string, b string, c string, d string"), ["a", "b", "c", "d"]).collect()}
    assert len(got) == 16 and np.isclose(got["a", "b"], 1) and np.isclose(got["b", "a"], 1) and np.isclose(got["a", "c"], 0, atol=1e-7)
    assert got["a", "a"] == 1.0 and np.isclose(got["a", "d"], 1)
    one = P.association(spark.createDataFrame([("x", "1"), ("x", "2")], "a string, b string"), ["a", "b"]).collect()
    assert {(r.col_a, r.col_b): r.v for r in one} == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0}


@pytest.mark.parametrize("seed", range(3))
def test_lambda_maximises_the_likelihood(spark, seed):
    r = np.random.default_rng(seed)
    x = {0: np.exp(r.normal(size=400)), 1: r.normal(size=400) ** 3, 2: r.gamma(2.0, size=400) - 1}[seed]
    df = spark.createDataFrame([(float(v), 5.0) for v in x], "v double, flat double")
    got = SH.fit_lambdas(df, ["v", "flat"])
    assert got["flat"] == 1.0
    near = {q["lambda"]: q.loglik for q in SH.yj_loglik(df, "v", [got["v"] + d for d in (-1e-3, 0, 1e-3)]).collect()}
    assert max(near, key=near.get) == got["v"]
    assert SH.fit_lambda(df.limit(0), "v") == 1.0
