"""Learners, ensembles, evaluation over time folds and parameter search
(SURVEY 2.9).  Boosted trees are ``operators.trees``; forests and linear models
are ``pyspark.ml``.

Fits run on executors; the driver only submits jobs (in parallel threads per
fold, all boosted models of a frame in one job) and receives metrics tables.
"""
from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timewise.operators.metrics import METRICS, metrics
from timewise.operators.trees import Frame, TreeLearner, TreeModel, TreeParams, all_predictions, fit_learners, fit_many

from timewise.sources.io import load_state, save_state

FEATURES = "features"
PRED = "prediction"


def gbt_leafwise(label: str, seed: int = 42, rounds: int = 300, **kw) -> TreeLearner:
    """Best-first boosted trees: 300 x 31 leaves, depth 8, step 0.05, 80 % of
    rows and columns a tree, >= 20 rows a leaf, penalties 0.1."""
    return TreeLearner(TreeParams(**{**dict(rounds=rounds, seed=seed), **kw}), label)


def gbt_depthwise(label: str, seed: int = 43, rounds: int = 300, **kw) -> TreeLearner:
    """Depth-wise boosted trees: as above with no limit of leaves and >= 5
    rows a leaf."""
    return TreeLearner(TreeParams(**{**dict(rounds=rounds, seed=seed, leaves=0, min_rows=5), **kw}), label)


def forest(label: str, seed: int = 44, trees: int = 200, **kw) -> RandomForestRegressor:
    """Random forest: 200 x depth 12, 80 % features, >= 5 rows per leaf."""
    p = dict(numTrees=trees, maxDepth=12, minInstancesPerNode=5, featureSubsetStrategy="0.8", seed=seed)
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, **{**p, **kw})


def ridge(label: str, alpha: float, n: int, y_sd: float) -> LinearRegression:
    """Ridge with the penalty alpha * ||b||^2 of the reference: Spark scales
    its penalty by the label sd and 1/n, so regParam = alpha * sd(y) / n."""
    reg = alpha * (y_sd or 1.0) / max(n, 1)
    return LinearRegression(featuresCol=FEATURES, labelCol=label, regParam=reg, elasticNetParam=0.0,
                            standardization=False, solver="normal")


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def vote(df: DataFrame, pred_cols: Sequence[str], name: str = "vote") -> DataFrame:
    """Mean of several prediction columns."""
    total = None
    for c in pred_cols:
        total = F.col(c) if total is None else total + F.col(c)
    return df.withColumn(name, total / F.lit(float(len(pred_cols))))


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return assembler(features).transform(df.drop(FEATURES))


@dataclass
class SingleModel:
    """One fitted learner with the features it takes."""
    models: list
    features: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.models[0].transform(_assembled(df, self.features)).drop(FEATURES)


@dataclass
class VotingModel:
    """Mean of the base predictions."""
    models: list
    features: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        out, names = base_predictions(self.models, df, self.features)
        return vote(out, names, PRED).drop(*names)


@dataclass
class StackingModel:
    """A ridge over the base predictions."""
    models: list
    features: Sequence[str]
    meta: object

    def transform(self, df: DataFrame) -> DataFrame:
        out, names = base_predictions(self.models, df, self.features)
        return self.meta.transform(_assembled(out, names)).drop(*names, FEATURES)


def base_predictions(models: Sequence, df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with one prediction column per fitted model."""
    out, names = _assembled(df, features), [f"_p{i}" for i in range(len(models))]
    for m, name in zip(models, names):
        out = m.transform(out).withColumnRenamed(PRED, name)
    return out.drop(FEATURES), names


def fit_all(estimators: Sequence, df: DataFrame, features: Sequence[str], threads: int = 4) -> list:
    """All estimators on the same rows: tree learners in one go, the others in
    threads beside them."""
    data = _assembled(df, features)
    trees = [e for e in estimators if isinstance(e, TreeLearner)]
    with ThreadPoolExecutor(max(1, threads)) as ex:
        grown = ex.submit(lambda: fit_learners(trees, df, features) if trees else [])
        others = [None if isinstance(e, TreeLearner) else ex.submit(e.fit, data) for e in estimators]
        ready = iter(grown.result())
        return [next(ready) if o is None else o.result() for o in others]


def with_params(estimator, changes: Mapping):
    """A copy of an estimator with other settings, by name."""
    if isinstance(estimator, TreeLearner):
        return estimator.copy(dict(changes))
    return estimator.copy({estimator.getParam(k): v for k, v in changes.items()})


def fit_single(estimator, df: DataFrame, features: Sequence[str]) -> SingleModel:
    return SingleModel(fit_all([estimator], df, features), list(features))


def fit_vote(estimators, df: DataFrame, features: Sequence[str]) -> VotingModel:
    return VotingModel(fit_all(estimators, df, features), list(features))


def fit_stack(estimators, df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0, folds: int = 2,
              fitted: Sequence | None = None) -> StackingModel:
    """Out-of-fold base predictions over contiguous blocks of the time index
    (``row_idx``, 0..n-1 in ``df``), a ridge fitted on those, and the bases
    fitted on all rows (``fitted`` where they already are).  Evaluation and
    final fit both come here, so they use the same blocks."""
    from timewise.operators.folds import IDX, block_fold
    cut = df.withColumn("_blk", block_fold(F.col(IDX), F.lit(df.count()), folds))
    oof = None
    for k in range(folds):
        part, names = base_predictions(fit_all(estimators, cut.where(F.col("_blk") != k), features), cut.where(F.col("_blk") == k), features)
        oof = part if oof is None else oof.unionByName(part)
    meta_in = _assembled(oof, names)
    st = meta_in.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sd")).first()
    meta = ridge(label, alpha, st["n"], st["sd"]).fit(meta_in)
    return StackingModel(list(fitted) if fitted is not None else fit_all(estimators, df, features), list(features), meta)


def fit_model(estimator, df: DataFrame, features: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[assembler(features), estimator]).fit(df)


KINDS = {"single": SingleModel, "voting": VotingModel, "stacking": StackingModel}


def save_learner(learner, path: str) -> dict:
    """Write the fitted stages under ``path``; returns what to remember."""
    kind = next(k for k, c in KINDS.items() if type(learner) is c)
    stages = [*learner.models, *([learner.meta] if kind == "stacking" else [])]
    own = [isinstance(m, TreeModel) for m in stages]
    for i, m in enumerate(stages):
        if own[i]:
            save_state(SparkSession.getActiveSession(), f"{path}/{i}", m.to_dict())
        else:
            m.write().overwrite().save(f"{path}/{i}")
    return {"kind": kind, "stages": len(stages), "features": list(learner.features), "trees": own}


def load_learner(spark, saved: dict, path: str):
    from pyspark.ml.util import DefaultParamsReader
    stages = [TreeModel.from_dict(load_state(spark, f"{path}/{i}")[0]) if saved["trees"][i] else DefaultParamsReader.loadParamsInstance(f"{path}/{i}", spark)
              for i in range(saved["stages"])]
    if saved["kind"] == "stacking":
        return StackingModel(stages[:-1], saved["features"], stages[-1])
    return KINDS[saved["kind"]](stages, saved["features"])


@dataclass
class Fold:
    """A time fold: labelled training and test rows in the learner's feature
    space, and the state that maps its label back (``state.target``)."""
    fold: int
    train: DataFrame
    test: DataFrame
    features: Sequence[str]
    state: object | None = None


def evaluate_folds(models: Mapping[str, object], folds: Sequence[Fold], label: str, threads: int = 4, ensembles: bool = True,
                   stack_alpha: float = 1.0, stack_folds: int = 2) -> DataFrame:
    """Fit every base learner once per fold, score the fold's test rows and
    return exact metrics per (model, fold); a fold whose state has a target
    transform adds ``_orig`` metrics.

    With ``ensembles`` the voting mean and the stacked ridge are evaluated
    from the same fitted bases.  The predictions of all models are unpivoted
    and measured in one grouped aggregation per scale."""
    names = list(models)

    def run(f: Fold) -> list[dict]:
        train = f.train.persist()
        fitted = fit_all([models[n] for n in names], train, f.features, threads)
        ready = {n: SingleModel([m], f.features) for n, m in zip(names, fitted)}
        if ensembles and len(names) > 1:
            ready["Voting"] = VotingModel(fitted, f.features)
            ready["Stacking"] = fit_stack([models[n] for n in names], train, f.features, label, stack_alpha, stack_folds, fitted)
        pred = f.test
        for i, m in enumerate(ready.values()):
            pred = m.transform(pred).withColumnRenamed(PRED, f"_m{i}")
        long = pred.select(label, *[f"_m{i}" for i in range(len(ready))]).unpivot(
            [label], [f"_m{i}" for i in range(len(ready))], "model", "_p").persist()
        out = {r["model"]: r.asDict() for r in metrics(long, label, "_p", by=["model"]).collect()}
        if f.state is not None:
            back = long.select("model", f.state.target.inverse(F.col(label)).alias(label), f.state.target.inverse(F.col("_p")).alias("_p"))
            for r in metrics(back, label, "_p", by=["model"]).collect():
                out[r["model"]].update({f"{c}_orig": r[c] for c in METRICS})
        long.unpersist()
        train.unpersist()
        return [{**out[f"_m{i}"], "model": n, "fold": f.fold} for i, n in enumerate(ready) if f"_m{i}" in out]

    with ThreadPoolExecutor(max(1, len(folds))) as ex:
        rows = [r for part in ex.map(run, folds) for r in part]
    spark = folds[0].train.sparkSession
    cols = ["n", *METRICS, *([f"{c}_orig" for c in METRICS] if folds[0].state is not None else [])]
    return spark.createDataFrame([(r["model"], r["fold"], *[r.get(c) for c in cols]) for r in rows],
                                 "model string, fold long, n long, " + ", ".join(f"{c} double" for c in cols[1:]))


def rank_models(per_fold: DataFrame) -> DataFrame:
    """Mean over folds; sorted by original-scale RMSE when present, else RMSE."""
    metric_cols = [c for c in per_fold.columns if c not in ("model", "fold")]
    avg = per_fold.groupBy("model").agg(*[F.avg(c).alias(c) for c in metric_cols])
    key = "rmse_orig" if "rmse_orig" in avg.columns else "rmse"
    return avg.orderBy(key, "model")


def best_model(ranked: DataFrame) -> str:
    return ranked.limit(1).first()["model"]


# Search ranges per learner family.
SEARCH_SPACE = {
    "gbt_leafwise": {"rounds": ("int", 200, 500), "rate": ("float", 0.01, 0.1), "leaves": ("int", 15, 100), "depth": ("int", 5, 15),
                     "min_rows": ("int", 10, 50), "rows": ("float", 0.7, 1.0), "cols": ("float", 0.7, 1.0),
                     "alpha": ("float", 0.01, 1.0), "lam": ("float", 0.01, 1.0)},
    "gbt_depthwise": {"rounds": ("int", 200, 500), "rate": ("float", 0.01, 0.1), "depth": ("int", 5, 15), "min_rows": ("int", 5, 50),
                      "rows": ("float", 0.7, 1.0), "cols": ("float", 0.7, 1.0), "alpha": ("float", 0.01, 1.0), "lam": ("float", 0.01, 1.0)},
    "forest": {"numTrees": ("int", 100, 300), "maxDepth": ("int", 8, 20), "minInstancesPerNode": ("int", 2, 10),
               "featureSubsetStrategy": ("one of", ["sqrt", "log2", "0.7", "0.8", "0.9"])},
}


def sample_params(space: Mapping[str, tuple], rng: random.Random) -> dict:
    draw = {"int": rng.randint, "float": rng.uniform, "share": lambda lo, hi: f"{rng.uniform(lo, hi):.6f}",
            "log": lambda lo, hi: math.exp(rng.uniform(math.log(lo), math.log(hi))), "one of": rng.choice}
    return {k: draw[kind](*bounds) for k, (kind, *bounds) in space.items()}


def search(make_estimator, space: Mapping[str, tuple], folds: Sequence[Fold], label: str, trials: int = 30, seed: int = 42,
           threads: int = 4) -> DataFrame:
    """Seeded random search: mean fold RMSE per trial, best first.

    Tree learners of all trials and folds are fitted together, and a fold's
    test rows are scored by all trials in one pass."""
    rng = random.Random(seed)
    params = [sample_params(space, rng) for _ in range(trials)]
    learners = [make_estimator(**p) for p in params]
    spark = folds[0].train.sparkSession
    ptab = spark.createDataFrame([(f"trial_{i}", str(p)) for i, p in enumerate(params)], "model string, params string")
    if all(isinstance(x, TreeLearner) for x in learners):
        frames = [Frame(f.train, list(f.features), label) for f in folds]
        jobs = [(k, x.params) for k in range(len(folds)) for x in learners]
        fitted = fit_many(jobs, frames)
        per_fold = None
        for k, f in enumerate(folds):
            mine = [TreeModel(t, list(f.features)) for (j, _), t in zip(jobs, fitted) if j == k]
            e = F.col("p") - F.col("y")
            # scoring by all trials is the work here, not reading: few test rows are spread
            test = f.test.select(label, *f.features).repartition(spark.sparkContext.defaultParallelism)
            long = test.select(F.col(label).cast("double").alias("y"), F.posexplode(all_predictions(mine)).alias("i", "p"))
            one = (long.where("y is not null").groupBy("i").agg(F.sqrt(F.avg(e * e)).alias("rmse"))
                   .select(F.concat(F.lit("trial_"), F.col("i").cast("string")).alias("model"), F.lit(k).cast("long").alias("fold"), "rmse"))
            rows = one.collect()               # one row a trial
            one = spark.createDataFrame(rows, one.schema)
            per_fold = one if per_fold is None else per_fold.unionByName(one)
    else:
        per_fold = evaluate_folds({f"trial_{i}": x for i, x in enumerate(learners)}, folds, label, threads, ensembles=False)
    return per_fold.groupBy("model").agg(F.avg("rmse").alias("rmse")).join(ptab, "model").orderBy("rmse", "model")
