"""Categorical encoding.

Fits are aggregations that return small state (a level list, a mapping, a
per-category sum table); transforms are projections or joins against that
state.  The past-only target encoder is the one ordered operator: it runs on
the partitioned prefix helper, never on an unpartitioned window.
"""
from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timewise.functions.text import clean_text_py
from timewise.plans.cache import held
from timewise.plans.prefix import BLOCK, in_blocks, running_totals


# ---------------------------------------------------------------- ordinal / bins
@dataclass
class OrdinalEncoder:
    """Literal map lookup; unmapped values become null; source dropped."""
    col: str
    mapping: Mapping[str, int]
    name: str | None = None
    clean_keys: bool = True
    drop_source: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        if self.col not in df.columns:
            return df
        keys = {(clean_text_py(k) if self.clean_keys else k): v for k, v in self.mapping.items()}
        m = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(int(v))) for k, v in keys.items()))
        out = df.withColumn(self.name or f"{self.col}_ordinal", m[F.col(self.col)].cast("int"))
        return out.drop(self.col) if self.drop_source else out


@dataclass
class BinSpecs:
    """0/1 columns from value lists (null counts as not in the list)."""
    col: str
    specs: Mapping[str, Sequence[str]]
    clean_values: bool = True
    drop_source: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        if self.col not in df.columns:
            return df
        cols = {}
        for new, values in self.specs.items():
            vals = [clean_text_py(v) if self.clean_values else v for v in values]
            cols[new] = F.coalesce(F.col(self.col).isin(vals), F.lit(False)).cast("int")
        out = df.withColumns(cols)
        return out.drop(self.col) if self.drop_source else out


# ---------------------------------------------------------------- cardinality
def cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column as (column, cardinality).

    One unpivot + two aggregations instead of many count_distinct (which
    would expand every row once per column before the shuffle)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").where(F.col("value").isNotNull())
    per_level = long.groupBy("column", "value").agg(F.lit(1).alias("one"))
    return per_level.groupBy("column").agg(F.count(F.lit(1)).cast("long").alias("cardinality"))


def route_categories(df: DataFrame, cols: Sequence[str], thresholds: Mapping[str, int],
                     target: str | None, date: str | None, default_threshold: int = 50) -> dict[str, str]:
    """'target' for columns above their threshold when target and date exist, else 'onehot'."""
    card = {r["column"]: r["cardinality"] for r in cardinality(df, cols).collect()}
    can_te = target is not None and date is not None and target in df.columns and date in df.columns
    return {c: ("target" if can_te and card.get(c, 0) > thresholds.get(c, default_threshold) else "onehot")
            for c in cols}


# ---------------------------------------------------------------- top-share one-hot
def level_shares(df: DataFrame, col: str, q: float) -> DataFrame:
    """Levels with counts, share, running count in (count desc, level asc,
    null last) order, and the keep / baseline decisions of the one-hot.

    Runs on the counted level table (one row per level).  The running count
    and the rank use the partitioned prefix helper, so even a column with
    millions of levels is never ranked in a single task."""
    counts = df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).cast("long").alias("n"))
    order = [F.col("n").desc(), F.col("level").asc_nulls_last()]
    t = running_totals(counts, order, {"cum_n": F.col("n"), "rank": F.lit(1).cast("long")}, inclusive=True,
                       totals=True)
    t = t.withColumnRenamed("cum_n__total", "total").drop("rank__total")
    within = F.col("cum_n").cast("double") <= F.lit(float(q)) * F.col("total").cast("double")
    # two numbers for the whole table: any level within q, rank of the top non-null level
    agg = t.agg(F.coalesce(F.max(within), F.lit(False)).alias("any_within"),
                F.min(F.when(F.col("level").isNotNull(), F.col("rank"))).alias("base_rank")).first()
    base_rank = agg["base_rank"] if agg["base_rank"] is not None else -1
    return t.select(
        "level", "n",
        F.round(F.col("n") / F.col("total"), 6).alias("share"),
        "cum_n", "rank",
        (within | ((F.col("rank") == 1) & F.lit(not agg["any_within"]))).alias("kept"),
        (F.col("rank") == F.lit(base_rank)).alias("baseline"),
    )


@dataclass
class OneHotModel:
    col: str
    levels: list[str]

    def columns(self) -> dict[str, Column]:
        return {f"{self.col}__{lvl}": F.coalesce(F.col(self.col) == F.lit(lvl), F.lit(False)).cast("int")
                for lvl in self.levels}

    def transform(self, df: DataFrame) -> DataFrame:
        if self.col not in df.columns:
            return df
        return df.withColumns(self.columns()).drop(self.col)


@dataclass
class TopShareOneHot:
    """Most frequent levels while the running share stays <= q; the most
    frequent non-null level is the dropped baseline; null gets no column."""
    col: str
    q: float = 1.0

    def fit(self, df: DataFrame) -> OneHotModel:
        t = level_shares(df, self.col, self.q)
        # one row per output column
        rows = t.where(F.col("kept") & ~F.col("baseline") & F.col("level").isNotNull()).orderBy("rank").collect()
        return OneHotModel(self.col, [r["level"] for r in rows])


# ---------------------------------------------------------------- target encoding
def _sum_type(y: Column, sum_scale: int | None) -> Column:
    return y.cast(f"decimal(18,{sum_scale})") if sum_scale is not None else y.cast("double")


@dataclass
class TargetEncodingModel:
    """Scoring-time state: per category sum/count of the training target and
    the overall mean.  Seen category -> smoothed mean; unseen or null -> prior."""
    col: str
    alpha: float
    prior: float
    state: DataFrame            # (col, te_sum, te_cnt)
    n_categories: int
    name: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        name = self.name or f"{self.col}__te"
        st = self.state.select(F.col(self.col).alias("_tw_cat"), "te_sum", "te_cnt")
        j = df.join(st, df[self.col] == st["_tw_cat"], "left")
        enc = F.when(F.col("te_cnt").isNull(), F.lit(self.prior)).otherwise(
            (F.col("te_sum") + F.lit(self.alpha) * F.lit(self.prior)) / (F.col("te_cnt") + F.lit(self.alpha)))
        return j.withColumn(name, enc).drop("_tw_cat", "te_sum", "te_cnt")


@dataclass
class PastTargetEncoder:
    """Past-only smoothed target encoding.

    For a row r in (date, tie) order: first row of its category -> 0.0; else
    (sum of earlier targets of the category + alpha * mean of all earlier
    targets) / (count of earlier rows of the category + alpha).  Null target
    -> null (after the first occurrence); null category -> null; null dates
    sort last.  ``same_day='exclude'`` lets only earlier days count (rows of
    one day never see each other), which needs no row-level ordering at all.
    ``sum_scale`` sums the target as DECIMAL(18, scale) so results do not
    depend on partitioning (exact for money columns)."""
    col: str
    target: str = "targetPrice"
    date: str = "saleDate"
    tie: Sequence[str] = ()
    alpha: float = 10.0
    same_day: str = "tie"
    sum_scale: int | None = None
    name: str | None = None
    n_blocks: int | None = None

    @property
    def out(self) -> str:
        return self.name or f"{self.col}__te"

    def _encode(self, cat: Column, y: Column, s_cat, n_cat, s_all, c_all) -> Column:
        prior = F.when(c_all > 0, s_all.cast("double") / c_all.cast("double")).otherwise(F.lit(0.0))
        rest = (s_cat.cast("double") + F.lit(self.alpha) * prior) / (n_cat.cast("double") + F.lit(self.alpha))
        return (F.when(cat.isNull(), F.lit(None).cast("double"))
                 .when(n_cat == 0, F.lit(0.0))
                 .when(y.isNull(), F.lit(None).cast("double"))
                 .otherwise(rest))

    def transform(self, df: DataFrame) -> DataFrame:
        if self.same_day == "exclude":
            with held(df):
                return self._transform_by_day(df)
        return self._transform_by_row(df)

    def _transform_by_row(self, df: DataFrame) -> DataFrame:
        """One range partitioning on (date, tie) serves both running totals.
        Inside a block they are windows over (block) and (block, category);
        what earlier blocks add is one number per block for all rows, and one
        per (block, category) for the category."""
        order = [F.col(self.date).asc_nulls_last()] + [F.col(t).asc_nulls_first() for t in self.tie]
        y = F.col(self.target)
        src = df.withColumns({"_tw_y": F.when(y.isNotNull(), _sum_type(y, self.sum_scale)),
                              "_tw_c": y.isNotNull().cast("long")})
        rows = in_blocks(src, order, self.n_blocks)
        cat = F.col(self.col)
        before = (Window.unboundedPreceding, -1)
        in_block = Window.partitionBy(BLOCK).orderBy(*order).rowsBetween(*before)
        in_cat = Window.partitionBy(BLOCK, cat).orderBy(*order).rowsBetween(*before)
        local = rows.withColumns({"_tw_s_all": F.sum("_tw_y").over(in_block), "_tw_c_all": F.sum("_tw_c").over(in_block),
                                  "_tw_s_cat": F.sum("_tw_y").over(in_cat), "_tw_n_cat": F.count(F.lit(1)).over(in_cat)})
        per_cat = rows.groupBy(BLOCK, self.col).agg(F.sum("_tw_y").alias("s"), F.sum("_tw_c").alias("c"), F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy(self.col).orderBy(BLOCK).rowsBetween(*before)
        off_cat = per_cat.select(F.col(BLOCK).alias("_tw_b"), cat.alias("_tw_k"), F.sum("s").over(earlier).alias("_tw_os"),
                                 F.sum("n").over(earlier).alias("_tw_on")).where("_tw_on is not null")
        # one row per block: at most n_blocks
        per_block = per_cat.groupBy(BLOCK).agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
        earlier = Window.orderBy(BLOCK).rowsBetween(*before)
        off_all = F.broadcast(per_block.select(F.col(BLOCK).alias("_tw_b2"), F.sum("s").over(earlier).alias("_tw_oa"),
                                               F.sum("c").over(earlier).alias("_tw_oc")))
        j = (local.join(off_cat, (F.col(BLOCK) == F.col("_tw_b")) & cat.eqNullSafe(F.col("_tw_k")), "left")
             .join(off_all, F.col(BLOCK) == F.col("_tw_b2"), "left"))

        def total(a: str, b: str) -> Column:
            zero = F.lit(0)
            return F.coalesce(F.col(a), zero) + F.coalesce(F.col(b), zero)

        enc = self._encode(cat, y, total("_tw_s_cat", "_tw_os"), total("_tw_n_cat", "_tw_on"),
                           total("_tw_s_all", "_tw_oa"), total("_tw_c_all", "_tw_oc"))
        return j.withColumn(self.out, enc).select(*[c for c in df.columns if c != self.out], self.out)

    def _transform_by_day(self, df: DataFrame) -> DataFrame:
        y = F.col(self.target)
        ys = _sum_type(y, self.sum_scale)
        d = F.col(self.date)
        per_cd = df.groupBy(self.col, self.date).agg(
            F.sum(F.when(y.isNotNull(), ys)).alias("_s"), F.count(F.lit(1)).alias("_n"))
        per_d = df.groupBy(self.date).agg(
            F.sum(F.when(y.isNotNull(), ys)).alias("_s"), F.count(y).alias("_c"))
        order = [d.asc_nulls_last()]
        cd = running_totals(per_cd, order, {"_tw_s_cat": F.col("_s"), "_tw_n_cat": F.col("_n")},
                            partition_by=[self.col], n_blocks=self.n_blocks)
        dd = running_totals(per_d, order, {"_tw_s_all": F.col("_s"), "_tw_c_all": F.col("_c")},
                            n_blocks=self.n_blocks)
        dd = dd.select(F.col(self.date).alias("_tw_d"), "_tw_s_all", "_tw_c_all")
        cd = cd.select(F.col(self.col).alias("_tw_k"), F.col(self.date).alias("_tw_d2"), "_tw_s_cat", "_tw_n_cat")
        j = (df.join(cd, df[self.col].eqNullSafe(cd["_tw_k"]) & df[self.date].eqNullSafe(cd["_tw_d2"]), "left")
               .join(dd, F.col(self.date).eqNullSafe(dd["_tw_d"]), "left"))
        enc = self._encode(F.col(self.col), y, F.col("_tw_s_cat"), F.col("_tw_n_cat"),
                           F.col("_tw_s_all"), F.col("_tw_c_all"))
        return j.withColumn(self.out, enc).drop("_tw_k", "_tw_d", "_tw_d2", "_tw_s_all", "_tw_c_all",
                                                "_tw_s_cat", "_tw_n_cat")

    def fit(self, df: DataFrame) -> TargetEncodingModel:
        y = F.col(self.target)
        ys = _sum_type(y, self.sum_scale)
        state = (df.where(F.col(self.col).isNotNull())
                   .groupBy(self.col)
                   .agg(F.sum(F.when(y.isNotNull(), ys)).cast("double").alias("te_sum"),
                        F.count(F.lit(1)).cast("double").alias("te_cnt")))
        tot = df.agg(F.sum(ys).cast("double").alias("s"), F.count(y).alias("c")).first()
        prior = float(tot["s"]) / tot["c"] if tot["c"] else 0.0
        state = state.checkpoint(eager=True)
        return TargetEncodingModel(self.col, self.alpha, prior, state, state.count(), self.out)
