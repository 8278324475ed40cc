"""What fits and scoring at size rest on: one task up to a bound, counted
columns, medians without ordering the rows."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import timewise.operators.stats as ST
import timewise.operators.trees as TR
import timewise.operators.treeshap as TS


def test_some_hundred_thousand_rows_are_fitted_in_one_task(spark, monkeypatch):
    def waves(*_):
        raise AssertionError("a job per wave")

    monkeypatch.setattr(TR, "_in_waves", waves)
    df = spark.range(250_000).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("y"))
    (t,) = TR.fit_many([(0, TR.TreeParams(rounds=1, leaves=2, depth=1))], [TR.Frame(df, ["a"], "y")])
    assert len(t) == 1


@pytest.mark.parametrize("n", [100, 5_000])
@pytest.mark.parametrize("plain", [True, False])
def test_only_the_columns_of_a_tree_are_counted(n, plain):
    rng = np.random.default_rng(n)
    bins, g = rng.integers(0, 8, (5, n)).astype(np.uint8), rng.normal(size=n)
    w = (rng.random(n) < 0.5).astype(float) if plain else rng.poisson(1.0, n).astype(float)
    c = TR.Counter(bins, 9, w, g, np.array([0, 3]))
    h = c.count(c.rows[1])
    assert not h[[1, 2, 4]].any()
    for j in (0, 3):
        assert np.array_equal(h[j, :, 0], np.bincount(bins[j], w, 9))
        assert np.allclose(h[j, :, 1], np.bincount(bins[j], w * g, 9))


def test_predictions_follow_the_nodes():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2_000, 3))
    x[rng.random(x.shape) < 0.05] = np.nan
    x[0, 0], x[1, 0] = np.inf, -np.inf
    edges = [np.unique(np.nanquantile(x[2:, j], np.arange(1, 16) / 16)) for j in range(3)]
    y = np.where(np.isnan(x[:, 1]), 1.0, np.sign(x[:, 1])) + (x[:, 2] > 0.3)
    base, grown = TR.fit_rows([(0, TR.bin_rows(x, edges), y)], TR.TreeParams(rounds=5, depth=6, leaves=20, min_rows=2))
    t = TR.assemble(base, grown, edges)
    got = t.predict(x)
    for r in range(0, 2_000, 97):
        want = t.base
        for k in range(len(t)):
            s, v = t.tree(k), 0
            while t.feature[s][v] >= 0:
                v = t.left[s][v] + (0 if x[r, t.feature[s][v]] <= t.cut[s][v] else 1)
            want += t.value[s][v]
        assert got[r] == want
    assert len(t.predict(x[:0])) == 0


def test_weights_of_all_signatures_at_once():
    k = 4
    leaf = TS.Leaf(3.0, np.arange(k), *[np.zeros(k)] * 2, *[np.zeros(k, bool)] * 2)
    masks, share = np.array([0, 3, 6, 9, 15]), np.array([0.1, 0.2, 0.3, 0.15, 0.25])
    got = TS.leaf_weights(leaf, np.arange(1 << k), masks, share)
    for x in range(1 << k):
        def worth(s):
            return 3.0 * sum(w for z, w in zip(masks, share) if ((x & s) | (z & ~s & 15)) == 15)

        for i in range(k):
            others = [j for j in range(k) if j != i]
            phi = 0.0
            for size in range(k):
                for sub in itertools.combinations(others, size):
                    s = sum(1 << j for j in sub)
                    phi += math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k) * (worth(s | 1 << i) - worth(s))
            assert abs(got[x, i] - phi) < 1e-12


def _spied(monkeypatch):
    seen, real = [], ST.running_totals

    def spy(df, *a, **k):
        seen.append(df)
        return real(df, *a, **k)

    monkeypatch.setattr(ST, "running_totals", spy)
    return seen


def test_medians_order_only_values_beside_them(spark, monkeypatch):
    seen = _spied(monkeypatch)
    df = spark.range(40_001).select((F.col("id") * 1.5).alias("a"), F.when(F.col("id") % 2 == 0, -F.col("id")).cast("double").alias("b"),
                                    F.when(F.col("id") % 3 == 0, float("nan")).otherwise(0.0).alias("c"), F.lit(None).cast("double").alias("d"))
    assert ST.median_map(df, ["a", "b", "c", "d"]) == {"a": 30_000.0, "b": -20_000.0, "c": 0.0, "d": None}
    (counts,) = seen
    assert counts.count() < 3_000              # of 60,000 values


def test_a_bracket_that_misses_its_median(spark, monkeypatch):
    monkeypatch.setattr(ST, "BRACKET", -0.2)
    seen = _spied(monkeypatch)
    df = spark.range(1_000).select(F.col("id").cast("double").alias("a"))
    assert ST.median_map(df, ["a"]) == {"a": 499.5}
    assert len(seen) == 2
