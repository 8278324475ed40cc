"""Exact quantiles (sketch brackets + ranking inside) against numpy."""
import numpy as np
import pytest

from timewise.operators.stats import quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def _frame(spark):
    rng = np.random.default_rng(3)
    rows = []
    # a hot group with heavy ties, a spread group, a one-value group, a two-value group
    rows += [("hot", float(v)) for v in np.concatenate([np.ones(3000), np.full(40, 2.0), rng.normal(size=500)])]
    rows += [("wide", float(v)) for v in rng.exponential(100.0, size=2000)]
    rows += [("one", 7.0), ("two", 1.0), ("two", 3.0)]
    rows += [("hot", None), ("wide", float("nan"))]
    return spark.createDataFrame(rows, "g string, x double"), rows


@pytest.mark.parametrize("accuracy", [5, 100, 10_000])
def test_quantiles_match_numpy(spark, accuracy):
    df, rows = _frame(spark)
    got = {r["g"]: r for r in quantiles(df, ["x"], PROBS, by=["g"], accuracy=accuracy).collect()}
    assert set(got) == {"hot", "wide", "one", "two"}
    for g in got:
        vals = np.array([v for k, v in rows if k == g and v is not None and np.isfinite(v)])
        for p in PROBS:
            want = float(np.quantile(vals, p))
            assert got[g][f"p{round(p * 100, 4):g}".replace(".", "_")] == pytest.approx(want, rel=1e-12, abs=1e-12)
