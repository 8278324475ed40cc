import math

import numpy as np
from pyspark.sql import functions as F

from timewise.functions.numeric import yeo_johnson, yeo_johnson_inverse
from timewise.operators import select as SE
from timewise.operators import shape as SH
from timewise.operators.score import align, score_histogram, validate


def test_yeo_johnson_roundtrip(spark):
    xs = [-5.0, -1.0, -0.1, 0.0, 0.3, 2.0, 50.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for lam in (-1.0, 0.0, 0.5, 2.0, 3.0):
        back = [r[0] for r in df.select(yeo_johnson_inverse(yeo_johnson("x", lam), lam)).collect()]
        for a, b in zip(xs, back):
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_fit_lambda_near_max_likelihood(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(0, 0.6, 3000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = SH.fit_lambda(df, "x")
    def ll(l):
        t = np.log1p(x) if abs(l) < 1e-12 else ((x + 1) ** l - 1) / l
        return -len(x) / 2 * np.log(t.var()) + (l - 1) * np.sum(np.log1p(x))
    grid = np.linspace(-3, 5, 8001)
    best = grid[np.argmax([ll(g) for g in grid])]
    assert abs(lam - best) < 0.01


def test_vif_gram_equals_regression(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 3))
    X[:, 2] = X[:, 0] * 0.9 + rng.normal(scale=0.3, size=300)
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    got = {r["column"]: r["vif"] for r in SE.vif(df, ["a", "b", "c"]).collect()}
    for i, name in enumerate("abc"):
        others = np.delete(X, i, axis=1)
        coef = np.linalg.lstsq(others, X[:, i], rcond=None)[0]
        ssr = np.sum((X[:, i] - others @ coef) ** 2)
        assert math.isclose(got[name], np.sum(X[:, i] ** 2) / ssr, rel_tol=1e-8)


def test_correlation_prune_uses_earlier_columns(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    rows = [(float(x), float(x * 2 + 0.01 * rng.normal()), float(rng.normal())) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    d = {r["column"]: r["dropped"] for r in SE.correlation_prune(df, ["a", "b", "c"], 0.8).collect()}
    assert d == {"a": False, "b": True, "c": False}


def test_backward_elimination_gram_matches_refit(spark):
    rng = np.random.default_rng(4)
    n = 250
    X = rng.normal(size=(n, 4))
    y = X[:, 0] * 3 + X[:, 1] + rng.normal(size=n)
    rows = [(i, i % 5, *map(float, X[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "i long, _fold long, a double, b double, c double, d double, y double")
    grams = SE.fold_grams(df, ["a", "b", "c", "d"], "y", "_fold")
    mse = SE.cv_mse_linear(grams, [0, 1])
    errs = []
    for k in range(5):
        tr, te = (np.array([r for r in rows if (r[1] != k) == flag]) for flag in (True, False))
        A = np.c_[np.ones(len(tr)), tr[:, 2:4]]
        coef = np.linalg.lstsq(A, tr[:, 6], rcond=None)[0]
        B = np.c_[np.ones(len(te)), te[:, 2:4]]
        errs.append(np.mean((te[:, 6] - B @ coef) ** 2))
    assert math.isclose(mse, float(np.mean(errs)), rel_tol=1e-9)
    out = SE.backward_eliminate(df, ["a", "b", "c", "d"], "y", 2, 4)
    assert set(out.features) >= {"a"} and len(out.features) + len(out.steps) == 4


def test_align_and_validate(spark):
    df = spark.createDataFrame([(1.0, "x", None)], "a double, extra string, b double")
    out = align(df, ["b", "a", "missing"])
    assert out.columns == ["b", "a", "missing"] and tuple(out.first()) == (0.0, 1.0, 0.0)
    bad = spark.createDataFrame([("3",), ("n/a",), (None,)], "door string")
    got = [r["bad_reason"] for r in validate(bad, {"door": ("double", True)}).collect()]
    assert got == [None, "type:door", "missing:door"]


def test_histogram_cumulative(spark):
    df = spark.createDataFrame([(500.0,), (1000.0,), (7000.0,), (2e6,)], "prediction double")
    rows = score_histogram(df).collect()
    cum = [r["cumulative"] for r in rows]
    assert cum == sorted(cum) and cum[0] == 2 and cum[-1] == 4


def _vif(spark, X):
    names = "abcdef"[:X.shape[1]]
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], ", ".join(f"{n} double" for n in names))
    return [r["vif"] for r in SE.vif(df, list(names)).collect()], df, list(names)


def test_vif_of_dependent_columns(spark):
    rng = np.random.default_rng(5)
    a, b, d = rng.normal(size=(3, 400))
    v, df, names = _vif(spark, np.c_[a, b, d, a + b + d])
    assert v == [math.inf] * 4
    assert [r["column"] for r in SE.vif_prune(df, names).collect()] == ["a"]
    v, _, _ = _vif(spark, np.c_[a, 2 * a, b])
    assert v[:2] == [math.inf] * 2 and 1 <= v[2] < 1.1
    v, _, _ = _vif(spark, np.c_[a, a + 1e-3 * b, d])
    assert 1e4 < v[0] < 1e8 and v[2] < 1.1
    v, _, _ = _vif(spark, np.c_[a, 0 * a])
    assert v[1] == 1.0


def test_lasso_path_meets_optimality(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(500, 5)) * [1, 10, 0.1, 1, 1]
    y = 3 * X[:, 0] - 0.2 * X[:, 1] + rng.normal(size=500) + 1000
    Xc, yc = X - X.mean(0), y - y.mean()
    xx, xy = Xc.T @ Xc / 500, Xc.T @ yc / 500
    for a, b in zip([1.0, 0.1], SE.lasso_path(xx, xy, [1.0, 0.1])):
        g = xy - xx @ b
        assert np.all(np.abs(g) <= a + 1e-6) and np.allclose(g[b != 0], a * np.sign(b[b != 0]), atol=1e-6)
    rows = [(i % 5, *map(float, X[i]), float(y[i])) for i in range(500)]
    df = spark.createDataFrame(rows, "_fold long, a double, b double, c double, d double, e double, y double")
    s = {r["feature"]: r["score"] for r in SE.lasso_scores(df, list("abcde"), "y").collect()}
    assert abs(s["a"] - 3) < 0.2 and abs(s["b"] - 0.2) < 0.05


def test_permutation_importance_numbers_rows_itself(spark):
    from pyspark.ml.regression import LinearRegression

    from timewise.operators.explain import permutation_importance, shapley_sampling
    from timewise.operators.models import assembler
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 3))
    df = spark.createDataFrame([(1000 + 7 * i, *map(float, X[i]), float(4 * X[i, 0] + X[i, 1])) for i in range(400)],
                               "id long, a double, b double, c double, y double")
    m = LinearRegression(labelCol="y").fit(assembler(["a", "b", "c"]).transform(df))
    got = {r["feature"]: r["importance_mean"] for r in permutation_importance(m, df, ["a", "b", "c"], "y", repeats=4).collect()}
    # permuting a column of a linear model costs 2 * b^2 * var(x) / var(y)
    vy = np.var(4 * X[:, 0] + X[:, 1])
    assert abs(got["a"] - 2 * 16 * X[:, 0].var() / vy) < 0.2 and abs(got["c"]) < 1e-6 and got["a"] > got["b"] > got["c"]
    s = shapley_sampling(m, df.limit(20), df, ["a", "b", "c"], "id", permutations=64).collect()
    assert len(s) == 60 and {len(r) for r in s} == {6}
    a = [r for r in s if r["feature"] == "a"]
    for r in a:
        x = X[(r["id"] - 1000) // 7]
        assert r["value"] == x[0] and abs(r["attribution"] - 4 * (x[0] - X[:, 0].mean())) < 2.5


def test_medians_are_exact_with_and_without_gaps(spark):
    from timewise.operators.sanitize import FinalImputer
    df = spark.createDataFrame([(float(i), float(i) if i % 2 else None) for i in range(1000)], "a double, b double")
    assert FinalImputer().fit(df).medians == {"a": 499.5, "b": 500.0}
