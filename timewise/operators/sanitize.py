"""Sanitizing, imputation, column pruning and z-scores.

Every fit is one or two aggregations returning numbers; every transform is a
projection with those numbers as literals, so it runs unchanged on a stream.
"""
from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from timewise.functions.numeric import finite, finite_frame
from timewise.operators.stats import median_map
from timewise.plans.cache import held_part


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


@dataclass(frozen=True)
class ColCfg:
    min_val: float | None = None
    max_val: float | None = None
    replace_with: str = "median"      # median | mean | none


# The domain defaults of the reference's numeric sanitizer.
DEFAULT_NUMERIC_CFG = {
    "kilometers": ColCfg(min_val=0),
    "cubeCapacity": ColCfg(),
    "powerKW": ColCfg(min_val=0),
    "cylinder": ColCfg(min_val=2, max_val=16),
    "vehicle_age_years": ColCfg(min_val=0),
    "km_per_year": ColCfg(min_val=0),
    "years_since_intro_at_sale": ColCfg(min_val=0),
}


@dataclass
class SanitizerModel:
    cfg: dict
    stats: dict          # column -> {"median", "mean", "std"}

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for c, cfg in self.cfg.items():
            if c not in df.columns or c not in self.stats:
                continue
            x = F.col(c)
            keep = F.lit(True)
            if cfg.min_val is not None:
                keep = keep & ~F.coalesce(x < F.lit(float(cfg.min_val)), F.lit(False))
            if cfg.max_val is not None:
                keep = keep & ~F.coalesce(x > F.lit(float(cfg.max_val)), F.lit(False))
            x = F.when(keep, x)
            fill = self.stats[c].get(cfg.replace_with) if cfg.replace_with in ("median", "mean") else None
            if fill is not None:
                x = F.coalesce(x, F.lit(float(fill)))
            cols[c] = x.cast("double")
        return df.withColumns(cols) if cols else df

    def to_json(self) -> str:
        return json.dumps({"cfg": {k: asdict(v) for k, v in self.cfg.items()}, "stats": self.stats})

    @staticmethod
    def from_json(s: str) -> "SanitizerModel":
        d = json.loads(s)
        return SanitizerModel({k: ColCfg(**v) for k, v in d["cfg"].items()}, d["stats"])


@dataclass
class NumericSanitizer:
    """Range mask (bounds inclusive) then fill with a fitted statistic.

    ``stats_on='raw'`` fits statistics before masking (the reference's
    order); ``'valid'`` fits them on in-range values only."""
    cfg: Mapping[str, ColCfg] = field(default_factory=lambda: dict(DEFAULT_NUMERIC_CFG))
    stats_on: str = "raw"
    median_method: str = "exact"

    def fit(self, df: DataFrame) -> SanitizerModel:
        cols = [c for c in self.cfg if c in df.columns]
        src = df
        if self.stats_on == "valid":
            src = SanitizerModel({c: ColCfg(self.cfg[c].min_val, self.cfg[c].max_val, "none") for c in cols},
                                 {c: {} for c in cols}).transform(df)
        # the statistics read these columns twice; other columns are never computed
        with held_part(df, finite_frame(src, cols)) as x:
            return SanitizerModel({c: self.cfg[c] for c in cols}, moments_and_medians(x, cols, self.median_method))


def moments_and_medians(df: DataFrame, cols: Sequence[str], median_method: str = "exact") -> dict:
    if not cols:
        return {}
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    row = finite_frame(df, cols).agg(*aggs).first()
    med = median_map(df, cols, median_method)
    return {c: {"median": med[c], "mean": row[f"{c}__mean"], "std": row[f"{c}__std"]} for c in cols}


@dataclass
class ImputerModel:
    medians: dict

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {c: F.coalesce(finite(c), F.lit(float(m)) if m is not None else F.lit(None).cast("double"))
                for c, m in self.medians.items() if c in df.columns}
        return df.withColumns(cols) if cols else df


@dataclass
class FinalImputer:
    """Null, NaN or +-inf -> median of the column's finite values (fit state)."""
    cols: Sequence[str] | None = None
    exclude: Sequence[str] = ()
    median_method: str = "exact"

    def fit(self, df: DataFrame) -> ImputerModel:
        """The exact median of every column, with gaps or without: the same
        numbers fill the training rows and, later, the gaps of new rows."""
        cols = list(self.cols) if self.cols is not None else numeric_columns(df, self.exclude)
        if not cols:
            return ImputerModel({})
        with held_part(df, finite_frame(df, cols)) as x:
            return ImputerModel(median_map(x, cols, self.median_method))


@dataclass
class PrunerModel:
    drop: list

    def transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in self.drop if c in df.columns])


@dataclass
class ColumnPruner:
    """Drop all-null columns and columns with at most one distinct value
    (null counted as a value).  One aggregation: min, max, non-null count per
    column - no distinct counting."""
    exclude: Sequence[str] = ()

    def decisions(self, df: DataFrame) -> DataFrame:
        cols = [c for c in df.columns if c not in self.exclude]
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, c in enumerate(cols):
            x = F.col(f"`{c}`")
            aggs += [F.count(x).alias(f"n{i}"), F.min(x).cast("string").alias(f"lo{i}"),
                     F.max(x).cast("string").alias(f"hi{i}")]
        row = df.agg(*aggs)
        parts = []
        for i, c in enumerate(cols):
            all_null = F.col(f"n{i}") == 0
            single = (F.col(f"n{i}") == F.col("__n")) & F.col(f"lo{i}").eqNullSafe(F.col(f"hi{i}"))
            parts.append(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null"),
                                  all_null.alias("all_null"), (all_null | single).alias("constant")))
        return row.select(F.explode(F.array(*parts)).alias("d")).select("d.*")

    def fit(self, df: DataFrame) -> PrunerModel:
        rows = self.decisions(df).collect()
        return PrunerModel([r["column"] for r in rows if r["all_null"] or r["constant"]])


@dataclass
class ZScoreModel:
    stats: dict

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {c: (F.col(c) - F.lit(s["mean"])) / F.lit(s["std"]) for c, s in self.stats.items() if c in df.columns}
        return df.withColumns(cols) if cols else df


@dataclass
class ZScore:
    """(x - mean) / sample sd, sd 0 or undefined -> 1.  Target excluded unless named."""
    cols: Sequence[str] | None = None
    exclude: Sequence[str] = ("targetPrice",)
    ddof: int = 1

    def fit(self, df: DataFrame) -> ZScoreModel:
        cols = list(self.cols) if self.cols is not None else numeric_columns(df, self.exclude)
        sd = F.stddev_samp if self.ddof == 1 else F.stddev_pop
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"{c}__m"), sd(c).alias(f"{c}__s")]
        row = finite_frame(df, cols).agg(*aggs).first() if cols else {}
        stats = {}
        for c in cols:
            s = row[f"{c}__s"]
            stats[c] = {"mean": row[f"{c}__m"] or 0.0, "std": s if s not in (None, 0.0) and s == s else 1.0}
        return ZScoreModel(stats)
