import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from timewise.llm import hard_negatives as hn

from .helpers import same_as_duckdb


def brute(rows, every=10, scale=256):
    use = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [max(-2**63, min(2**63 - 1, math.floor(scale * x))) for x in v])
        use[i] = min(use.get(i, row), row)
    score = lambda a, b: sum(x * y for x, y in zip(use[a][1], use[b][1]))      # noqa: E731
    out = set()
    for a in use:
        if a % every:
            continue
        order = sorted((-score(a, b), b) for b in use)
        same = [(b, -s) for s, b in order if b != a and use[b][0] == use[a][0]][:5]
        other = [(b, -s) for s, b in order if use[b][0] != use[a][0]]
        for p, ps in same:
            fit = [(b, s) for b, s in other if 80 * ps <= 100 * s <= 100 * ps][:5]
            out |= {(a, p, r, b, ps, s) for r, (b, s) in enumerate(fit, 1)}
    return out


def frame(spark, rows):
    """Rows with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, 1, 2, "x", b"y") for r in rows],
                                 "vec_id long, label int, embedding array<double>, cell int, leaf long, anchor string, vec binary")


def clustered(seed, n, dim=6, centres=7, labels=3):
    r = np.random.default_rng(seed)
    c = r.normal(size=(centres, dim))
    return [(i, int(r.integers(labels)), [float(x) for x in c[r.integers(centres)] + 0.2 * r.normal(size=dim)]) for i in range(n)]


def same(spark, rows, **kw):
    got = [tuple(r) for r in hn.mine(frame(spark, rows), F.col("id") % 10 == 0, **kw).collect()]
    want = brute(rows)
    assert len(got) == len(set(got)) and set(got) == want
    return got


@pytest.mark.parametrize("seed,n,kw", [(1, 300, {}), (2, 400, {"cell_rows": 16, "ways": 4}), (3, 250, {"cell_rows": 8, "ways": 8})])
def test_against_brute_force(spark, seed, n, kw):
    assert len(same(spark, clustered(seed, n), **kw)) > 100


def test_ties_copies_and_hot_vector(spark):
    r = random.Random(5)
    rows = [(i, r.randint(0, 2), [float(r.randint(0, 2)) for _ in range(3)]) for i in range(150)]
    rows += [(150 + i, i % 3, [1.0, 1.0, 1.0]) for i in range(150)]
    same(spark, rows, cell_rows=16, ways=4)


def test_edges(spark):
    assert same(spark, []) == []
    assert same(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) == []
    bad = [(None, 1, [1.0, 1.0]), (3, None, [1.0, 1.0]), (4, 1, None), (5, 1, [1.0, None]), (6, 1, [float("nan"), 1.0]), (7, 2, [float("inf"), 1.0])]
    rows = clustered(6, 60, dim=2) + bad + [(30, 0, [0.5, 0.5]), (30, 0, [0.5, 0.5]), (31, 2, [9.0, 9.0])]
    rows += [(100, 1, []), (110, 1, [0.5]), (120, 1, [0.5, 0.25, 0.125, 4.0]), (130, 1, [-3.0, -3.0])]
    same(spark, rows)
    same(spark, rows, cell_rows=8, ways=3)


def test_large_components_are_exact(spark):
    """Products beyond 2**53, where floats would round."""
    r = random.Random(8)
    rows = [(i, i % 2, [float(r.randint(2**20, 2**20 + 5)) for _ in range(4)]) for i in range(80)]
    assert len(same(spark, rows, cell_rows=16, ways=4)) > 20


def test_elimination_is_safe_and_useful():
    """No row in the annulus lies in an eliminated leaf; some leaves go."""
    r = np.random.default_rng(4)
    x = np.floor(256 * np.concatenate([r.normal(size=(150, 8)) * 0.05 + c for c in r.normal(size=(12, 8))]))
    tree = hn.grow(x, len(x), float(np.sqrt((x * x).sum(1).max())), ways=4, leaf_rows=40)
    y = tree.lifted(x)
    tree.lo, tree.hi = ([np.full((len(p), len(p)), z) for p in tree.points] for z in (np.inf, -np.inf))
    for v, _, d, c in tree.walk(y):
        for j in np.unique(c):
            tree.lo[v][:, j] = np.minimum(tree.lo[v][:, j], d[c == j].min(0))
            tree.hi[v][:, j] = np.maximum(tree.hi[v][:, j], d[c == j].max(0))
    leaf, q = tree.leaf_of(y), x[::37]
    assert tree.leaves > 10 and len(np.unique(leaf)) > 10
    s = q @ x.T
    top = (q * q).sum(1) + tree.norm ** 2
    far = np.sqrt(np.maximum(top - 2 * np.sort(s, 1)[:, -20], 0))
    near = np.sqrt(np.maximum(top - 2 * np.sort(s, 1)[:, -3], 0))
    alive = tree.survivors(q, near, far)
    d = np.sqrt(np.maximum(top[:, None] - 2 * s, 0))
    for i, j in np.argwhere((d >= near[:, None]) & (d <= far[:, None])):
        assert alive[i, leaf[j]]
    assert alive.mean() < 0.6


def test_same_as_duckdb(spark, sf):
    same_as_duckdb(spark, sf, "op12_gnat_negatives")
