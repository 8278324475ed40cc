"""Histogram trees against a plain best-first reference, and the two ways of
fitting against each other."""
import numpy as np
import pytest

from timewise.operators import models as MO
from timewise.operators import trees as TR


def data(n, p=4, seed=0, ties=False):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(n, p)), 1) if ties else r.normal(size=(n, p))
    return x, 3 * (x[:, 0] > 0.2) + x[:, 1] * (x[:, 2] > 0) + 0.1 * r.normal(size=n)


def edges_of(x, bins):
    return [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins, method="inverted_cdf")) for j in range(x.shape[1])]


def plain_tree(x, g, edges, p):
    """One split at a time: (rows, leaf values), in plain loops."""
    def shrunk(s):
        return np.sign(s) * max(abs(s) - p.alpha, 0)

    def worth(rows):
        return shrunk(g[rows].sum()) ** 2 / (len(rows) + p.lam)

    def best(rows, depth):
        found = (0.0, None)
        if depth >= p.depth:
            return found
        for f in range(x.shape[1]):
            for cut in edges[f]:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(left), len(right)) >= p.min_rows:
                    gain = worth(left) + worth(right) - worth(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
        return found

    leaves = [(np.arange(len(x)), 0, best(np.arange(len(x)), 0))]
    while not p.leaves or len(leaves) < p.leaves:
        k = max(range(len(leaves)), key=lambda i: leaves[i][2][0])
        if leaves[k][2][1] is None:
            break
        _, depth, (_, halves) = leaves.pop(k)
        leaves += [(rows, depth + 1, best(rows, depth + 1)) for rows in halves]
    out = np.zeros(len(x))
    for rows, _, _ in leaves:
        out[rows] = -p.rate * shrunk(g[rows].sum()) / (len(rows) + p.lam)
    return out, len(leaves)


@pytest.mark.parametrize("leaves,depth,min_rows,ties", [(7, 8, 5, False), (15, 4, 20, True), (0, 3, 5, False), (31, 15, 2, True), (2, 1, 1, False)])
def test_boosting_equals_a_plain_best_first_tree(leaves, depth, min_rows, ties):
    x, y = data(500, ties=ties, seed=leaves)
    p = TR.TreeParams(rounds=4, rate=0.3, leaves=leaves, depth=depth, min_rows=min_rows, alpha=0.5, lam=1.0, rows=1.0, cols=1.0, bins=16)
    edges = edges_of(x, p.bins)
    base, grown = TR.fit_rows([(0, TR.bin_rows(x, edges), y)], p)
    model = TR.assemble(base, grown, edges)
    want = np.full(len(y), y.mean())
    for t in range(p.rounds):
        step, n = plain_tree(x, want - y, edges, p)
        want = want + step
        assert n == (model.feature[model.tree(t)] < 0).sum()
    assert np.allclose(model.predict(x), want)


def test_one_stump_in_closed_form():
    x, y = np.array([[1.0], [2.0], [3.0], [4.0]]), np.array([0.0, 0.0, 10.0, 10.0])
    p = TR.TreeParams(rounds=1, rate=1.0, leaves=2, depth=1, min_rows=1, alpha=0.0, lam=0.0, rows=1.0, cols=1.0)
    base, grown = TR.fit_rows([(0, TR.bin_rows(x, [np.array([1.0, 2.0, 3.0])]), y)], p)
    m = TR.assemble(base, grown, [np.array([1.0, 2.0, 3.0])])
    assert np.allclose(m.predict(np.array([[2.0], [2.5], [np.nan]])), [0, 10, 10]) and m.gain.max() == 100


def frame(spark, x, y):
    names = [f"f{j}" for j in range(x.shape[1])]
    return spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join(f"{c} double" for c in (*names, "y"))), names


@pytest.mark.parametrize("kw", [dict(rounds=12, leaves=9), dict(rounds=3, leaves=0, depth=4, min_rows=3), dict(rounds=4, forest=True, leaves=0, depth=5, min_rows=3)])
def test_both_ways_give_one_result(spark, kw):
    x, y = data(700, seed=5)
    df, names = frame(spark, x, y)
    df = df.repartition(3).cache()
    jobs = [(0, TR.TreeParams(bins=16, **kw)), (1, TR.TreeParams(bins=16, seed=7, **kw))]
    make = lambda: [TR.Frame(df, names, "y"), TR.Frame(df.where("f0 > -0.5"), names, "y")]      # noqa: E731
    a, b = TR.fit_many(jobs, make()), TR.fit_many(jobs, make(), task_rows=0)
    for u, v in zip(a, b):
        assert len(u) == kw["rounds"] and np.array_equal(u.feature, v.feature) and np.allclose(u.predict(x), v.predict(x))
    assert not np.allclose(a[0].predict(x), a[1].predict(x))
    df.unpersist()


def test_model_frames_and_edges(spark, tmp_path):
    x, y = data(400, seed=9)
    df, names = frame(spark, x, y)
    learner = MO.gbt_leafwise("y", rounds=40, min_rows=5)
    one = MO.fit_single(learner, df, names)
    got = {(r.f0, r.f1): r.prediction for r in one.transform(df).collect()}
    assert np.mean([(got[tuple(a[:2])] - b) ** 2 for a, b in zip(x, y)]) < 0.2 * y.var()
    imp = one.models[0].featureImportances.toArray()
    assert abs(imp.sum() - 1) < 1e-9 and imp.argmax() == 0
    both = MO.fit_stack([learner, MO.gbt_depthwise("y", rounds=10), MO.forest("y", trees=5, maxDepth=4)], df.selectExpr("*", "row_number() over (order by f0) - 1 as row_idx"),
                        names, "y")
    saved = MO.save_learner(both, str(tmp_path / "m"))
    again = MO.load_learner(spark, saved, str(tmp_path / "m"))
    a, b = (sorted(r.prediction for r in m.transform(df).collect()) for m in (both, again))
    assert np.allclose(a, b)
    # nulls and NaN go right, constant columns are never split, no rows give no trees
    odd = spark.createDataFrame([(None, 1.0, 2.0), (float("nan"), 1.0, 2.0), (0.0, 1.0, 1.0), (0.5, 1.0, None)] * 5, "f0 double, f1 double, y double")
    m = MO.gbt_leafwise("y", rounds=60, rate=0.3, min_rows=1, rows=1.0, cols=1.0, alpha=0.0, lam=0.0).fit(odd, ["f0", "f1"])
    assert [round(r.prediction, 3) for r in m.transform(odd).limit(4).collect()][:3] == [2.0, 2.0, 1.0] and set(m.trees.feature) <= {-1, 0}
    assert MO.gbt_leafwise("y", rounds=3).fit(odd.where("f0 > 9 and not isnan(f0)"), ["f0"]).transform(odd).first().prediction == 0.0


def test_search_shares_one_fit(spark):
    x, y = data(300, seed=3)
    df, names = frame(spark, x, y)
    folds = [MO.Fold(k, df.where(f"f3 < {c}"), df.where(f"f3 >= {c}"), names) for k, c in enumerate((0.0, 0.5))]
    space = {"rounds": ("int", 5, 20), "leaves": ("int", 2, 8)}
    got = MO.search(lambda **p: MO.gbt_leafwise("y", min_rows=5, **p), space, folds, "y", trials=4).collect()
    assert [r.rmse for r in got] == sorted(r.rmse for r in got) and len(got) == 4
    import random
    rng = random.Random(42)
    params = [MO.sample_params(space, rng) for _ in range(4)]
    one = MO.evaluate_folds({"m": MO.gbt_leafwise("y", min_rows=5, **params[2])}, folds, "y", ensembles=False)
    assert np.isclose(np.mean([r.rmse for r in one.collect()]), {r.model: r.rmse for r in got}["trial_2"])
