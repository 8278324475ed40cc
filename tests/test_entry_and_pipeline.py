import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "make_model__te" in df.columns


def test_every_query_has_callable_and_oracles_are_subset():
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) >= 60
    assert set(o) <= set(q)


@pytest.mark.parametrize("name", ["chronology_guard", "target_encode", "metrics_by_group", "onehot_levels",
                                  "profile", "time_folds", "write_partitioned", "vif", "vif_singular", "vif_prune", "mutual_info",
                                  "score_rows", "score_batch", "score_stream", "score_windows_stream",
                                  "importance_csv", "report_json", "xy_split", "default_column"])
def test_selected_queries_match_duckdb(spark, sf, name):
    import duckdb
    sys_path = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    from tools.oracle_check import TABLES, compare
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = entry.queries()[name](spark, sf)
    rel = con.execute(entry.oracle_sql()[name])
    msg = compare([tuple(r) for r in df.collect()], df.columns, rel.fetchall(), [d[0] for d in rel.description])
    assert msg is None, msg


def test_pipeline_one_row_equals_batch(spark, sf):
    """Scoring a row alone gives the same features as inside a batch (no per-batch relearning)."""
    from timewise.plans.fixtures import TIE_KEY, sales
    from timewise.plans.q_io import _fixture_cfg
    from timewise.plans.preprocess import Preprocessor
    s = sales(spark, sf)
    model = Preprocessor(_fixture_cfg()).fit(s)
    batch = model.transform(s).orderBy(*TIE_KEY).limit(5).collect()
    key = {c: batch[0][c] for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")}
    one_src = s.where(" AND ".join(f"{k} = {v}" for k, v in key.items()))
    one = model.transform(one_src).collect()
    assert len(one) == 1
    assert one[0].asDict() == batch[0].asDict()


def test_pipeline_save_load_roundtrip(spark, sf, tmp_path):
    from timewise.plans.fixtures import TIE_KEY, sales
    from timewise.plans.q_io import _fixture_cfg
    from timewise.plans.preprocess import Preprocessor, PreprocessorModel
    s = sales(spark, sf)
    m = Preprocessor(_fixture_cfg()).fit(s)
    m.save(str(tmp_path / "p"))
    m2 = PreprocessorModel.load(str(tmp_path / "p"), _fixture_cfg())
    a = m.transform(s).orderBy(*TIE_KEY).collect()
    b = m2.transform(s).orderBy(*TIE_KEY).collect()
    assert a == b


def test_batch_equals_stream(spark, sf, tmp_path):
    from timewise.functions.numeric import yeo_johnson
    from timewise.session import read
    from timewise.sources import io
    from timewise.streaming.stream import score_stream
    ev = read(spark, sf, "events").select("event_id", "ts", "value")
    src = str(tmp_path / "src")
    io.write_table(ev.repartition(3), src)
    f = lambda d: d.withColumn("score", yeo_johnson(F.col("value") + 1, 0.2))
    q = score_stream(spark, src, ev.schema, f, str(tmp_path / "sink"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "sink")).collect())
    want = sorted(tuple(r) for r in f(ev).collect())
    assert got == want


def test_windowed_monitoring_stream_equals_batch(spark, sf, tmp_path):
    """Every window of the batch form is there, over several micro-batches of unordered rows."""
    from timewise.operators.score import score_windows
    from timewise.session import read
    from timewise.sources import io
    from timewise.streaming.stream import read_windows, score_metrics_stream
    ev = read(spark, sf, "events").select("event_id", "ts", "value")
    src = str(tmp_path / "src")
    io.write_table(ev.repartition(3), src)
    q = score_metrics_stream(io.read_stream(spark, src, ev.schema, max_files_per_trigger=1), "ts", "value", str(tmp_path / "sink"),
                             str(tmp_path / "ck"), watermark=None)
    q.awaitTermination()
    got = read_windows(spark, str(tmp_path / "sink")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    got = {r["window_start"]: (r["count"], round(r["sum"], 6)) for r in got.collect()}
    assert got == {r["window_start"]: (r["count"], round(r["sum"], 6)) for r in score_windows(ev, "ts", "value").collect()}


def test_streaming_dedupe_needs_a_watermark(spark, sf, tmp_path):
    from timewise.operators.clean import dedupe
    from timewise.session import read
    from timewise.sources import io
    ev = read(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    src = str(tmp_path / "src")
    io.write_table(ev.union(ev.limit(40)), src)
    stream = io.read_stream(spark, src, ev.schema)
    with pytest.raises(ValueError):
        dedupe(stream)
    q = (dedupe(stream, ["event_id"], "ts", "3650 days").writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == ev.count()


def _toy(spark, n=400, scale=1.0):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3))
    y = np.exp(1.5 + 0.8 * x[:, 0] + 0.3 * rng.normal(size=n))
    late = np.arange(n) >= n // 2
    x[late] *= scale
    y[late] *= scale
    rows = [(i, f"2020-{1 + i // 40:02d}-01", *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, d string, a double, b double, c double, y double").withColumn("d", F.to_date("d"))


def test_folds_never_see_test_rows(spark):
    """Changing the later rows leaves the state of a fold that trains on
    earlier ones as it is; prefit takes in all rows."""
    from timewise.operators.folds import time_index
    from timewise.plans.train import TrainConfig, fold_frames
    cfg = TrainConfig(target="y", date="d", tie=["id"], exclude=("id",), select=False, folds=2)
    states = [[f.state.to_dict() for f in fold_frames(time_index(_toy(spark, scale=k), "d", ["id"]), ["a"], cfg)] for k in (1.0, 9.0)]
    assert states[0][0] == states[1][0] and states[0][1] != states[1][1]
    cfg.prefit = True
    shared = [[f.state.to_dict() for f in fold_frames(time_index(_toy(spark, scale=k), "d", ["id"]), ["a"], cfg)] for k in (1.0, 9.0)]
    assert shared[0][0] == shared[0][1] and shared[0][0] != shared[1][0]


def test_train_save_load_and_score(spark, tmp_path):
    from timewise.plans.train import TrainConfig, train
    from timewise.plans.trained import TrainedModel
    df = _toy(spark)
    cfg = TrainConfig(target="y", date="d", tie=["id"], exclude=("id",), rounds=3, trees=3, folds=1, trials=1, n_features=4,
                      select_methods=("f_test", "lasso"), log_path=str(tmp_path / "log"),
                      spaces={k: {"maxDepth": ("int", 2, 3)} for k in ("GBT_leafwise", "GBT_depthwise", "RandomForest")})
    r = train(df, cfg)
    assert {x["model"] for x in r.ranking.collect()} == {"GBT_leafwise", "GBT_depthwise", "RandomForest", "Voting", "Stacking"}
    h = {x["role"]: x for x in r.holdout.collect()}
    assert set(h) == {"train", "test"} and all(h[k]["rmse_orig"] is not None and h[k]["n"] > 0 for k in h)
    assert spark.read.parquet(str(tmp_path / "log")).select("kind").distinct().count() == 4
    r.model.save(str(tmp_path / "m"))
    loaded = TrainedModel.load(str(tmp_path / "m"))
    new = df.drop("y").union(df.drop("y").limit(5)).withColumn("b", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("b")))
    a, b = ({(x["id"], x["prediction"]) for x in m.predict(new).collect()} for m in (r.model, loaded))
    assert a == b and loaded.predict(new).count() == new.count() and all(p is not None for _, p in a)
    one = loaded.predict(new.where("id = 14")).first()["prediction"]
    assert (14, one) in a


def test_ensembles_save_and_load(spark, tmp_path):
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression

    from timewise.operators import models as MO
    from timewise.operators.folds import time_index
    df = time_index(_toy(spark), "d", ["id"]).persist()
    est = [LinearRegression(labelCol="y"), DecisionTreeRegressor(labelCol="y", maxDepth=3)]
    for i, m in enumerate((MO.fit_vote(est, df, ["a", "b"]), MO.fit_stack(est, df, ["a", "b"], "y"))):
        saved = MO.save_learner(m, str(tmp_path / str(i)))
        again = MO.load_learner(spark, saved, str(tmp_path / str(i)))
        assert [r["prediction"] for r in m.transform(df).orderBy("id").collect()] == [r["prediction"] for r in again.transform(df).orderBy("id").collect()]
    df.unpersist()


def test_scoring_keeps_every_row(spark, sf):
    from timewise.plans.fixtures import sales
    from timewise.plans.preprocess import Preprocessor
    from timewise.plans.q_io import _fixture_cfg
    s = sales(spark, sf)
    few = s.limit(50)
    out = Preprocessor(_fixture_cfg()).fit(s).transform(few.union(few))
    assert out.count() == 100 and out.where("guard_reason is not null").count() == 2 * few.where("yearIntroduced > year(saleDate)").count()


def test_model_queries_take_the_defaults(spark, sf, monkeypatch):
    """The registered model queries run the operators' own settings."""
    from types import SimpleNamespace
    from timewise.operators import models as MO
    from timewise.operators import select as SE
    from timewise.plans import q_explain, train as T
    from timewise.plans.preprocess import Preprocessor
    from timewise.plans.q_io import _train_cfg
    got, q = {}, entry.queries()
    monkeypatch.setattr(Preprocessor, "fit_transform", lambda self, df: (None, df))
    monkeypatch.setattr(T, "train", lambda clean, cfg: got.update(cfg=cfg) or SimpleNamespace(ranking=None))
    q["train_flow"](spark, sf)
    assert got["cfg"] == _train_cfg() and got["cfg"].spaces is None
    assert (got["cfg"].rounds, got["cfg"].trees, got["cfg"].trials, tuple(got["cfg"].select_methods)) == (300, 200, 30, tuple(SE.SCORERS))

    def searched(make, space, folds, label, trials=30, seed=42, **kw):
        got.update(space=space, trials=trials, least=make(**{k: b[1] for k, b in space.items()}))
        return None
    monkeypatch.setattr(MO, "search", searched)
    monkeypatch.setattr(T, "fold_frames", lambda *a: [])
    q["param_search"](spark, sf)
    assert got["trials"] == 30 and got["space"] is MO.SEARCH_SPACE["gbt_leafwise"]
    assert (got["least"].params.rounds, got["least"].params.leaves, got["least"].params.depth) == (200, 15, 5)

    monkeypatch.setattr(SE, "method_scores", lambda df, cols, y: spark.createDataFrame(
        [("f_test", c, i, i + 1.0) for i, c in enumerate(cols)], "method string, feature string, position long, score double"))
    monkeypatch.setattr(SE, "forest_scores", lambda df, cols, y, trees=100, **kw: got.setdefault("rfe", []).append(trees) or spark.createDataFrame(
        [(c, i, float(i)) for i, c in enumerate(cols)], "feature string, position long, score double"))
    q["compare_selectors"](spark, sf)
    assert set(got["rfe"]) == {100}

    made = []
    monkeypatch.setattr(q_explain, "forest", lambda *a, **kw: made.append(MO.forest(*a, **kw)) or MO.forest(q_explain.Y, trees=1, maxDepth=1))
    q["explain_report"](spark, sf)
    assert (made[0].getNumTrees(), made[0].getMaxDepth()) == (200, 12)


def test_a_scorer_of_zeros_does_not_count(spark):
    from timewise.operators.select import rank_ensemble
    rows = [("f_test", "a", 0, 1.0), ("f_test", "b", 1, 4.0), ("lasso", "a", 0, 0.0), ("lasso", "b", 1, 0.0)]
    got = rank_ensemble(spark.createDataFrame(rows, "method string, feature string, position long, score double"), 2).orderBy("rank").collect()
    assert [(r["feature"], r["combined"]) for r in got] == [("b", 1.0), ("a", 0.25)]
