"""Registered queries for sources/sinks, the fitted pipeline, the training
flow and streaming (SURVEY 2.1, 2.9, 2.12)."""
from __future__ import annotations

from pyspark.sql import functions as F

from timewise.operators.metrics import metrics
from timewise.plans.common import KEY4, normalize
from timewise.plans.fixtures import AESTHETIC_MAP, MECHANICAL_MAP, TIE_KEY, clean_sales, sales
from timewise.plans.q_metrics import PRED_CTE, metrics_sql, predictions
from timewise.plans import q_explain, q_metrics, q_score  # noqa: F401  (registers the queries reused below)
from timewise.plans.fixtures import with_sales
from timewise.plans.registry import ORACLES, QUERIES, query
from timewise.session import read
from timewise.sources import io

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate date, o_orderpriority string")


@query("read_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""")
def q_read_roundtrip(spark, sf):
    o = read(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = io.scratch_path(spark, "roundtrip")
    io.write_table(o, path, fmt="csv")
    return io.read_table(spark, path, ORDERS_SCHEMA, fmt="csv")



# A2: the cleaned table written as parquet partitioned by sale year, read back
# (partition values come back from the folder names).
@query("write_partitioned", with_sales("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, saleDate, targetPrice,
       CAST(year(saleDate) AS INTEGER) AS sale_year
FROM sales"""))
def q_write_partitioned(spark, sf):
    s = sales(spark, sf).select(*KEY4, "saleDate", "targetPrice", F.year("saleDate").alias("sale_year"))
    path = io.scratch_path(spark, "partitioned")
    io.write_table(s, path, fmt="parquet", partition_by=["sale_year"])
    return io.read_table(spark, path, fmt="parquet").select(*KEY4, "saleDate", "targetPrice", "sale_year")


IMPORTANCE_SCHEMA = "feature string, importance double, rank bigint, importance_pct double"


# A3: the ranked importance table as CSV with header, read back with its schema.
@query("importance_csv", ORACLES["importance_ranking"])
def q_importance_csv(spark, sf):
    ranked = QUERIES["importance_ranking"](spark, sf)
    path = io.scratch_path(spark, "importance-csv")
    io.write_table(ranked, path, fmt="csv")
    return io.read_table(spark, path, IMPORTANCE_SCHEMA, fmt="csv")


METRICS_REPORT_SCHEMA = ("model string, fold string, n bigint, rmse double, mae double, r2 double, mape double, "
                         "smape double, wmape double, mdae double, max_error double, q25_error double, "
                         "q75_error double, q90_error double, explained_variance double")


# A4: a run report (metrics per model and fold) as JSON lines, read back.
@query("report_json", ORACLES["metrics_by_group"])
def q_report_json(spark, sf):
    rep = QUERIES["metrics_by_group"](spark, sf)
    path = io.scratch_path(spark, "report-json")
    io.write_report(rep, path)
    return spark.read.schema(METRICS_REPORT_SCHEMA).json(path).select(*rep.columns)

RUN_KEYS = ["n", "rmse", "mae", "r2"]


@query("run_log_pivot", f"""
WITH {PRED_CTE}, g AS ({metrics_sql("y", "p", ("model", "fold"))})
SELECT model || '/' || fold AS run_id, CAST(n AS DOUBLE) AS n, rmse, mae, r2 FROM g""")
def q_run_log(spark, sf):
    per = normalize(metrics(predictions(spark, sf), "y", "p", by=["model", "fold"]))
    per = per.select(F.concat_ws("/", "model", "fold").alias("run"), *RUN_KEYS)
    path = io.scratch_path(spark, "runlog")
    io.log_metrics_table(per, path, "run")
    piv = io.run_log_pivot(spark, path, "metric", RUN_KEYS)
    return piv.select("run_id", *[F.col(k).cast("double").alias(k) for k in RUN_KEYS])


def _fixture_cfg():
    from timewise.plans.preprocess import DomainConfig, DEFAULT_CATEGORICAL_CFG
    cat = dict(DEFAULT_CATEGORICAL_CFG)
    cat["aestheticGrade"] = {"ordinal": True, "ordinal_mapping": AESTHETIC_MAP}
    cat["mechanicalGrade"] = {"ordinal": True, "ordinal_mapping": MECHANICAL_MAP}
    cat["type"] = {"top_cum_q": 1.0, "bin_specs": {"type_big": ["LARGE", "MEDIUM"]}}
    return DomainConfig(categorical_cfg=cat, tie=TIE_KEY, sum_scale=2)


CUT = "1999-01-01"


@query("preprocess_fit_transform")
def q_preprocess(spark, sf):
    from timewise.plans.preprocess import Preprocessor
    s = sales(spark, sf)
    model, out = Preprocessor(_fixture_cfg()).fit_transform(s)
    return out


@query("preprocess_score")
def q_preprocess_score(spark, sf):
    from timewise.plans.preprocess import Preprocessor, PreprocessorModel
    s = sales(spark, sf)
    train = s.where(F.col("saleDate") < F.lit(CUT).cast("date"))
    test = s.where(F.col("saleDate") >= F.lit(CUT).cast("date"))
    model = Preprocessor(_fixture_cfg()).fit(train)
    path = io.scratch_path(spark, "pipeline")
    model.save(path)
    loaded = PreprocessorModel.load(path, _fixture_cfg())
    return loaded.transform(test)


# Scoring keeps every row: as many out as in, with the guard's objections.
@query("score_rows", with_sales("""
SELECT count(*) AS rows_in, count(*) AS rows_out, count(*) FILTER (yearIntroduced > year(saleDate)) AS guarded FROM sales"""))
def q_score_rows(spark, sf):
    from timewise.plans.preprocess import Preprocessor
    s = sales(spark, sf)
    model = Preprocessor(_fixture_cfg()).fit(s.where(F.col("saleDate") < F.lit(CUT).cast("date")))
    return s.agg(F.count(F.lit(1)).alias("rows_in")).crossJoin(
        model.transform(s).agg(F.count(F.lit(1)).alias("rows_out"), F.count("guard_reason").alias("guarded")))


def _linear(label, cfg):
    from pyspark.ml.regression import LinearRegression
    return {"Linear": LinearRegression(featuresCol="features", labelCol=label, solver="normal")}


def linear_model(spark, sf):
    """A saved and reloaded model whose learner has a closed form."""
    from timewise.operators import models as MO
    from timewise.plans.trained import LABEL, TrainedModel, fit_features
    li = read(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    state = fit_features(li, "l_extendedprice", ["l_quantity"], skew_limit=float("inf"))
    learner = MO.fit_single(_linear(LABEL, None)["Linear"], state.labelled(li), state.features)
    path = io.scratch_path(spark, "model")
    TrainedModel(state, learner).save(path)
    return TrainedModel.load(path)


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("score_batch", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 4) AS prediction
FROM lineitem, (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)""")
def q_score_batch(spark, sf):
    p = linear_model(spark, sf).predict(read(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity"))
    return normalize(p.select(*LINE_KEY, F.round("prediction", 4).alias("prediction")))


def _train_cfg(**kw):
    from timewise.plans.train import TrainConfig
    return TrainConfig(tie=TIE_KEY, exclude=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), **kw)


# Every setting at its default: rounds, trees, trials, scorers, search spaces.
@query("train_flow")
def q_train(spark, sf):
    from timewise.plans.preprocess import Preprocessor
    from timewise.plans.train import train
    _, clean = Preprocessor(_fixture_cfg()).fit_transform(sales(spark, sf))
    return train(clean, _train_cfg()).ranking


# The hold-out check on both scales with a linear learner: a target that is
# positive and skewed is transformed, so the two scales differ.
@query("train_holdout")
def q_train_holdout(spark, sf):
    from timewise.plans.train import TrainConfig, train
    ev = read(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), F.col("user_id").cast("double").alias("user"),
                                          (F.col("event_id") % 97).cast("double").alias("turn"), (F.col("value") + 1).alias("y"))
    cfg = TrainConfig(target="y", date="day", tie=["event_id"], exclude=("event_id",), select=False, trials=0, ensembles=False, learners=_linear)
    h = train(ev, cfg).holdout
    return h.select("role", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2", "mdae", "rmse_orig", "mae_orig", "r2_orig", "mdae_orig")])


@query("score_stream", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 4) AS prediction
FROM lineitem, (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)""")
def q_score_stream(spark, sf):
    """Rows dropped as files into a folder, scored by a stream with a fitted,
    saved and reloaded model, read back from the file sink."""
    from timewise.streaming.stream import score_stream
    rows = read(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity")
    src = io.scratch_path(spark, "stream-src")
    io.write_table(rows, src)
    sink, ck = io.scratch_path(spark, "stream-sink"), io.scratch_path(spark, "stream-ck")
    score_stream(spark, src, rows.schema, linear_model(spark, sf).predict, sink, ck).awaitTermination()
    return normalize(spark.read.parquet(sink).select(*LINE_KEY, F.round("prediction", 4).alias("prediction")))


@query("score_windows_stream", ORACLES["score_windows"])
def q_windows_stream(spark, sf):
    from timewise.streaming.stream import read_windows, score_metrics_stream
    ev = read(spark, sf, "events").select("ts", (F.col("value") * 100).cast("decimal(18,2)").alias("v"))
    src = io.scratch_path(spark, "wstream-src")
    io.write_table(ev.repartition(4), src)
    stream = io.read_stream(spark, src, ev.schema, max_files_per_trigger=2)
    sink, ck = io.scratch_path(spark, "wstream-sink"), io.scratch_path(spark, "wstream-ck")
    score_metrics_stream(stream, "ts", "v", sink, ck, watermark=None).awaitTermination()
    return normalize(read_windows(spark, sink))


# One best-first tree of two leaves without penalties: the split of largest
# gain over all cuts of two features, and the means of its two sides.
@query("boosted_stump", """
WITH cuts AS (SELECT 0 AS f, CAST(l_linenumber AS DOUBLE) AS x FROM lineitem UNION SELECT 1, l_discount FROM lineitem),
g AS (SELECT f, x, sum(y) FILTER (v <= x) AS sl, count(*) FILTER (v <= x) AS nl, sum(y) FILTER (v > x) AS sr, count(*) FILTER (v > x) AS nr
      FROM cuts JOIN (SELECT 0 AS k, CAST(l_linenumber AS DOUBLE) AS v, l_extendedprice AS y FROM lineitem UNION ALL
                      SELECT 1, l_discount, l_extendedprice FROM lineitem) ON k = f GROUP BY f, x),
b AS (SELECT * FROM g WHERE nl >= 20 AND nr >= 20 ORDER BY sl * sl / nl + sr * sr / nr DESC, f, x LIMIT 1)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       round(CASE WHEN CASE f WHEN 0 THEN l_linenumber ELSE l_discount END <= x THEN sl / nl ELSE sr / nr END, 3) AS prediction
FROM lineitem, b""")
def q_stump(spark, sf):
    from timewise.operators import models as MO
    li = read(spark, sf, "lineitem")
    stump = MO.gbt_leafwise("l_extendedprice", rounds=1, rate=1.0, leaves=2, depth=1, alpha=0.0, lam=0.0, rows=1.0, cols=1.0)
    p = MO.fit_single(stump, li, ["l_linenumber", "l_discount"]).transform(li)
    return normalize(p.select(*LINE_KEY, F.round("prediction", 3).alias("prediction")))


@query("param_search")
def q_search(spark, sf):
    """Seeded random search over boosted-tree settings on expanding time folds."""
    from timewise.operators import models as MO
    from timewise.operators import select as SE
    from timewise.operators.folds import time_index
    from timewise.plans.q_select import FEATS, Y
    from timewise.plans.train import fold_frames
    s = SE.filled(clean_sales(spark, sf), FEATS, Y, keep=[*TIE_KEY, "saleDate"])
    idx = time_index(s, "saleDate", TIE_KEY).persist()
    frames = fold_frames(idx, FEATS, _train_cfg(select=False))
    return MO.search(lambda **p: MO.gbt_leafwise("_label", **p), MO.SEARCH_SPACE["gbt_leafwise"], frames, "_label")
