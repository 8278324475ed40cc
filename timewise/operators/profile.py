"""Profiling.  Every function returns a small long-form
DataFrame computed by one or two aggregations over the input; nothing is
collected unless a later step needs a literal."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from timewise.functions.numeric import finite, finite_frame, sample_excess_kurtosis, sample_skew
from timewise.operators.stats import quantiles
from timewise.session import ensure_checkpoint_dir


def kind_of(dt) -> str:
    if isinstance(dt, (NumericType, BooleanType)):
        return "numeric"
    if isinstance(dt, StringType):
        return "string"
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return "datetime"
    return "other"


def _q(c: str):
    return F.col(f"`{c}`")


def _explode_structs(row_df: DataFrame, structs) -> DataFrame:
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def info(df: DataFrame) -> DataFrame:
    """(position, column, kind, dtype, non_null) per column, one aggregation."""
    aggs = [F.count(_q(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(i).cast("long").alias("position"), F.lit(f.name).alias("column"),
                        F.lit(kind_of(f.dataType)).alias("kind"), F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.col(f"n{i}").cast("long").alias("non_null"))
               for i, f in enumerate(df.schema.fields)]
    return _explode_structs(row, structs)


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group.  Copies collapse in the
    map-side partial aggregation, so a huge group of copies never reaches one task whole."""
    cols = list(subset) if subset else df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def missing_profile(df: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(_q(c).isNull()).alias(f"m{i}")
                                              for i, c in enumerate(df.columns)]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").cast("long").alias("n_missing"),
                        F.round(F.col(f"m{i}") / F.col("_n") * 100.0, 6).alias("pct_missing"))
               for i, c in enumerate(df.columns)]
    return _explode_structs(row, structs)


def missing_patterns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Co-missing pattern ('1' = null, in column order) with its row count."""
    cols = list(cols) if cols else df.columns
    pat = F.concat(*[F.when(_q(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """n, mean, bias-corrected skewness and excess kurtosis per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.skewness(x).alias(f"g{i}"),
                 F.kurtosis(x).alias(f"k{i}")]
    row = finite_frame(df, cols).agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("n"),
                        F.col(f"m{i}").alias("mean"),
                        sample_skew(F.col(f"g{i}"), F.col(f"n{i}")).alias("skew"),
                        sample_excess_kurtosis(F.col(f"k{i}"), F.col(f"n{i}")).alias("kurtosis"))
               for i, c in enumerate(cols)]
    return _explode_structs(row, structs)


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    wide = df.select(*[finite(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull())


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), empty bins
    included.  A constant column spans [v - 0.5, v + 0.5]."""
    long = _long(df, cols)
    rng = long.groupBy("column").agg(F.min("value").alias("lo0"), F.max("value").alias("hi0"))
    same = F.col("lo0") == F.col("hi0")
    rng = rng.select("column", F.when(same, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(same, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    rng = F.broadcast(rng)  # one row per column
    b = F.least(F.floor((F.col("value") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))),
                F.lit(bins - 1)).cast("long")
    counts = long.join(rng, "column").groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (grid.join(counts, ["column", "bin"], "left")
                .select("column", F.col("bin").cast("long").alias("bin"),
                        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count")))


def box_stats(df: DataFrame, cols: Sequence[str], whis: float = 1.5, method: str = "exact") -> DataFrame:
    """Quartiles, fences at whis * IQR, whisker ends (extreme values inside
    the fences) and outlier count per column."""
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method)
    q = q.select("column", F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"),
                 (F.col("p75") - F.col("p25")).alias("iqr"))
    q = q.withColumns({"lo_fence": F.col("q1") - F.lit(whis) * F.col("iqr"),
                       "hi_fence": F.col("q3") + F.lit(whis) * F.col("iqr")})
    long = _long(df, cols).join(F.broadcast(q.select("column", "lo_fence", "hi_fence")), "column")
    inside = (F.col("value") >= F.col("lo_fence")) & (F.col("value") <= F.col("hi_fence"))
    w = long.groupBy("column").agg(F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
                                   F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
                                   F.count_if(~inside).cast("long").alias("n_outliers"))
    return q.join(w, "column")


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair (diagonal 1.0 where the sample
    standard deviation is positive), over the rows where both are finite, from
    blocked cross products (``operators.gram``)."""
    from timewise.operators.gram import correlations
    r = correlations(finite_frame(df, cols), cols)
    rows = [(a, b, None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def association(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cramer's V for every ordered pair of text columns (diagonal 1.0 where
    there are two levels), over the rows where both are present: 0 for
    independent columns, 1 where one decides the other.

    One grouped count per pair of levels (combined map-side) is all that is
    taken from the rows; margins and the statistic come from the counts."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, v double")
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(f"t{i}") for i, c in enumerate(cols)])
    at = {c: f"t{i}" for i, c in enumerate(cols)}
    gen = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(at[a]).alias("x"), F.col(at[b]).alias("y")) for a, b in pairs])
    cells = (text.select(F.inline(gen)).where("x is not null and y is not null").groupBy("col_a", "col_b", "x", "y").agg(F.count(F.lit(1)).alias("n")))
    ensure_checkpoint_dir(df.sparkSession)
    cells = cells.checkpoint()                 # counted once, read by margins, totals and statistic
    mx = cells.groupBy("col_a", "col_b", "x").agg(F.sum("n").alias("nx"))
    my = cells.groupBy("col_a", "col_b", "y").agg(F.sum("n").alias("ny"))
    total = mx.groupBy("col_a", "col_b").agg(F.sum("nx").alias("n_all"), F.count(F.lit(1)).alias("r"))
    levels = my.groupBy("col_a", "col_b").agg(F.count(F.lit(1)).alias("c"))
    part = (cells.join(mx, ["col_a", "col_b", "x"]).join(my, ["col_a", "col_b", "y"])
            .groupBy("col_a", "col_b").agg(F.sum(F.col("n").cast("double") * F.col("n") / (F.col("nx").cast("double") * F.col("ny"))).alias("s")))
    least = F.least(F.col("r"), F.col("c")) - 1
    v = F.when(least > 0, F.sqrt(F.greatest(F.lit(0.0), F.col("s") - 1.0) / least))
    per = part.join(total, ["col_a", "col_b"]).join(levels, ["col_a", "col_b"]).select("col_a", "col_b", v.alias("v"))
    both = per.unionByName(per.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "v"))
    own = text.select(*[F.when(F.min(at[c]) < F.max(at[c]), F.lit(1.0)).alias(f"v{i}") for i, c in enumerate(cols)])
    diagonal = own.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.col(f"v{i}").alias("v")) for i, c in enumerate(cols)])))
    return both.unionByName(diagonal)


def top_values(df: DataFrame, cols: Sequence[str], k: int = 10, null_label: str = "Unknown") -> DataFrame:
    """Most frequent k values per column (count desc, value asc), nulls as a label.
    The row_number filter becomes a per-partition group limit before the
    shuffle (Spark's window group limit), so a high-cardinality column
    sends at most k rows per partition to the final task."""
    wide = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null_label)).alias(c) for c in cols])
    counts = wide.unpivot([], list(cols), "column", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).cast("long").alias("count"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn(
        "rank", F.col("rank").cast("long"))


def chronology_violations(df: DataFrame, sale: str = "saleDate", reg: str = "registrationDate",
                          year: str = "yearIntroduced") -> DataFrame:
    """Rows sold before 1 January of their introduction year or registered after sale."""
    y = F.col(year).cast("int")
    intro = F.make_date(y, F.lit(1), F.lit(1))
    before_intro = F.coalesce(F.col(sale) < intro, F.lit(False))
    reg_after = F.coalesce(F.col(reg) > F.col(sale), F.lit(False))
    return df.withColumns({"sold_before_intro": before_intro, "registered_after_sale": reg_after}).where(
        before_intro | reg_after)


def profile(df: DataFrame, method: str = "exact") -> DataFrame:
    """Per column: kind, count, missing, distinct, zeros, and for numbers
    min, max, mean, sd, quartiles.  Distinct counts by one unpivot and two
    group-bys (no many-column count_distinct)."""
    num = [f.name for f in df.schema.fields if kind_of(f.dataType) == "numeric"]
    df = df.select(*[finite(f"`{f.name}`").alias(f.name) if f.name in num else F.col(f"`{f.name}`")
                     for f in df.schema.fields])
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        aggs.append(F.count(_q(f.name)).alias(f"c{i}"))
        if f.name in num:
            x = _q(f.name)
            aggs += [F.count_if(x == 0).alias(f"z{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                     F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    row = df.agg(*aggs)
    none = F.lit(None).cast("double")
    structs = []
    for i, f in enumerate(fields):
        isnum = f.name in num
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(kind_of(f.dataType)).alias("kind"),
            F.col(f"c{i}").cast("long").alias("count"), (F.col("_n") - F.col(f"c{i}")).cast("long").alias("missing"),
            (F.col(f"z{i}").cast("long") if isnum else F.lit(None).cast("long")).alias("zeros"),
            (F.col(f"lo{i}") if isnum else none).alias("min"), (F.col(f"hi{i}") if isnum else none).alias("max"),
            (F.col(f"m{i}") if isnum else none).alias("mean"), (F.col(f"s{i}") if isnum else none).alias("sd")))
    base = _explode_structs(row, structs)
    long = df.select(*[_q(f.name).cast("string").alias(f.name) for f in fields]).unpivot(
        [], [f.name for f in fields], "column", "value").where(F.col("value").isNotNull())
    distinct = long.groupBy("column", "value").agg(F.lit(1).alias("o")).groupBy("column").agg(
        F.count(F.lit(1)).cast("long").alias("distinct"))
    out = base.join(distinct, "column", "left").withColumn("distinct", F.coalesce("distinct", F.lit(0)).cast("long"))
    if num:
        q = quantiles(df, num, [0.25, 0.5, 0.75], method=method)
        out = out.join(q, "column", "left")
    else:
        out = out.withColumns({"p25": none, "p50": none, "p75": none})
    return out


def level_balance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Imbalance per categorical column: 1 - entropy / ln(levels) (0 = even)."""
    counts = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    ensure_checkpoint_dir(df.sparkSession)
    counts = counts.checkpoint()               # counted once, read by totals and shares
    tot = counts.groupBy("column").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k"))
    j = counts.join(F.broadcast(tot), "column")
    p = F.col("n") / F.col("t")
    ent = j.groupBy("column", "k").agg(F.sum(-p * F.log(p)).alias("h"))
    return ent.select("column", F.col("k").cast("long").alias("levels"),
                      F.when(F.col("k") > 1, F.lit(1.0) - F.col("h") / F.log(F.col("k").cast("double")))
                       .otherwise(F.lit(0.0)).alias("imbalance"))


def alerts(profile_df: DataFrame, corr_df: DataFrame, balance_df: DataFrame, corr_threshold: float = 0.9,
           imbalance_threshold: float = 0.5, high_cardinality: int = 50, assoc_df: DataFrame | None = None) -> DataFrame:
    """Alerts as (column, alert, value): high correlation of numbers and, with
    ``assoc_df``, of text columns (each unordered pair once, on the first
    column), imbalance, high cardinality, unique."""
    hc = corr_df.where((F.col("col_a") < F.col("col_b")) & (F.abs("r") > corr_threshold)).select(
        F.col("col_a").alias("column"), F.concat(F.lit("high_correlation:"), F.col("col_b")).alias("alert"),
        F.col("r").alias("value"))
    if assoc_df is not None:
        hc = hc.unionByName(assoc_df.where((F.col("col_a") < F.col("col_b")) & (F.col("v") > corr_threshold)).select(
            F.col("col_a").alias("column"), F.concat(F.lit("high_correlation:"), F.col("col_b")).alias("alert"), F.col("v").alias("value")))
    imb = balance_df.where(F.col("imbalance") > imbalance_threshold).select(
        "column", F.lit("imbalance").alias("alert"), F.col("imbalance").alias("value"))
    # both profile alerts from one read of the profile table
    dist = F.col("distinct").cast("double")
    per_col = F.array(
        F.struct(((F.col("kind") == "string") & (F.col("distinct") > high_cardinality)).alias("on"),
                 F.lit("high_cardinality").alias("alert"), dist.alias("value")),
        F.struct(((F.col("distinct") == F.col("count")) & (F.col("missing") == 0)).alias("on"),
                 F.lit("unique").alias("alert"), dist.alias("value")))
    prof = (profile_df.select("column", F.inline(per_col))
            .where(F.col("on")).select("column", "alert", "value"))
    return hc.unionByName(imb).unionByName(prof)


def sample_n(df: DataFrame, n: int, seed: int = 0, key: Sequence[str] | None = None) -> DataFrame:
    """Deterministic sample of n rows: smallest seeded MD5 of the key's text.
    Planned as a distributed top-k (per-partition top n, then merge)."""
    cols = list(key) if key else df.columns
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(_q(c).cast("string"), F.lit("")) for c in cols]))
    return df.withColumn("_h", h).orderBy("_h", *[_q(c) for c in cols]).limit(n).drop("_h")


def verify(df: DataFrame) -> DataFrame:
    """Output check: rows, columns, columns by kind, total null cells."""
    kinds = [kind_of(f.dataType) for f in df.schema.fields]
    nulls = [F.count_if(_q(c).isNull()) for c in df.columns]
    total = nulls[0] if nulls else F.lit(0)
    for e in nulls[1:]:
        total = total + e
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_cols"),
                  F.lit(kinds.count("numeric")).cast("long").alias("n_numeric"),
                  F.lit(kinds.count("string")).cast("long").alias("n_string"),
                  F.lit(kinds.count("datetime")).cast("long").alias("n_datetime"),
                  F.lit(kinds.count("other")).cast("long").alias("n_other"),
                  total.cast("long").alias("null_cells"))


def melt(df: DataFrame, id_cols: Sequence[str], metrics: Sequence[str], descending: Sequence[str] = ("r2",),
         name: str = "metric", value: str = "value") -> DataFrame:
    """Wide metrics to long, with each id's rank inside its metric (best first:
    descending for the named metrics, ascending otherwise)."""
    long = df.unpivot(list(id_cols), list(metrics), name, value)
    desc = F.col(name).isin(list(descending))
    key = F.when(desc, -F.col(value)).otherwise(F.col(value))
    w = Window.partitionBy(name).orderBy(key.asc_nulls_last(), *[F.col(c) for c in id_cols])
    return long.withColumn("rank", F.row_number().over(w).cast("long"))
