"""Stateless cleaning steps.  Each is DataFrame -> DataFrame,
a pure projection or filter, valid on streaming frames as well."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from timewise.functions.dates import DAY_FIRST_FORMATS, age_years, as_date
from timewise.functions.numeric import safe_ratio, to_number
from timewise.functions.text import clean_text


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    names = set(df.columns)
    return [c for c in cols if c in names]


def parse_dates(df: DataFrame, cols: Sequence[str] = ("saleDate",),
                formats: Sequence[str] = DAY_FIRST_FORMATS) -> DataFrame:
    """Day-first text (or timestamps) to DATE; misfits become null."""
    return df.withColumns({c: as_date(df, c, formats) for c in _present(df, cols)})


def dedupe(df: DataFrame, subset: Sequence[str] | None = None, event_time: str | None = None,
           within: str = "1 day") -> DataFrame:
    """Drop exact duplicate rows.  Spark aggregates map-side first, so a
    group of many copies collapses before the shuffle.

    On a stream the seen rows are state, which a watermark has to bound:
    name the ``event_time`` column, and copies that arrive ``within`` that
    time of each other collapse."""
    if df.isStreaming:
        if event_time is None:
            raise ValueError("dedupe on a stream needs event_time; its state would grow for ever")
        return df.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(subset or df.columns))
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def to_numbers(df: DataFrame, cols: Sequence[str] = ("doorNumber",)) -> DataFrame:
    """Text to DOUBLE; unparsable, NaN and inf become null."""
    return df.withColumns({c: to_number(c) for c in _present(df, cols)})


GUARD = "guard_reason"


def chronology_guard(df: DataFrame, year_col: str = "yearIntroduced", date_col: str = "saleDate",
                     min_year: float = 1900.0, flag: bool = False) -> DataFrame:
    """Drop rows introduced after the sale year (null years kept), null out
    years before ``min_year``, derive sale_year and years_since_intro_at_sale.
    With ``flag`` no row goes; ``guard_reason`` says what is wrong (or null)."""
    if date_col not in df.columns:
        return df
    out = df.withColumn("sale_year", F.year(date_col))
    if year_col not in df.columns:
        return out.withColumn(GUARD, F.lit(None).cast("string")) if flag else out
    y = to_number(year_col)
    late = F.coalesce(F.col(year_col) > F.col("sale_year").cast("double"), F.lit(False))
    out = out.withColumn(year_col, y)
    out = out.withColumn(GUARD, F.when(late, F.lit(f"{year_col} after {date_col}"))) if flag else out.where(~late)
    out = out.withColumn(year_col, F.when(F.col(year_col) >= F.lit(min_year), F.col(year_col)))
    return out.withColumn("years_since_intro_at_sale",
                          (F.col("sale_year").cast("double") - F.col(year_col)))


def chronology_dropped(df: DataFrame, year_col: str = "yearIntroduced", date_col: str = "saleDate") -> DataFrame:
    """Count of rows the guard drops (one row)."""
    return df.agg(F.count_if(F.coalesce(to_number(year_col) > F.year(date_col).cast("double"),
                                        F.lit(False))).cast("long").alias("dropped"))


def mask_nonpositive(df: DataFrame, cols: Sequence[str] = ("cubeCapacity",)) -> DataFrame:
    """Values <= 0 (and unparsable) become null."""
    return df.withColumns({c: F.when(to_number(c) > 0, to_number(c)) for c in _present(df, cols)})


def date_parts(df: DataFrame, date_col: str = "saleDate") -> DataFrame:
    if date_col not in df.columns:
        return df
    return df.withColumns({"sale_year": F.year(date_col), "sale_month": F.month(date_col)})


def age_and_rate(df: DataFrame, start: str = "registrationDate", end: str = "saleDate",
                 distance: str = "kilometers") -> DataFrame:
    """vehicle_age_years = whole days / 365.25; km_per_year = distance / age
    with zero age giving null."""
    out = df
    if start in df.columns and end in df.columns:
        out = out.withColumn("vehicle_age_years", age_years(start, end))
    if distance in out.columns and "vehicle_age_years" in out.columns:
        out = out.withColumn("km_per_year", safe_ratio(distance, "vehicle_age_years"))
    return out


def composite(df: DataFrame, cols: Sequence[str] = ("make", "model"), sep: str = "_",
              name: str = "make_model", drop_sources: bool = True) -> DataFrame:
    """Null-propagating concatenation (a null part gives a null composite)."""
    if not all(c in df.columns for c in cols):
        return df
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.col(c).cast("string"))
    out = df.withColumn(name, F.concat(*parts))
    return out.drop(*cols) if drop_sources else out


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*_present(df, cols))


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


def clean_text_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = string_columns(df) if cols is None else _present(df, cols)
    return df.withColumns({c: clean_text(c) for c in cols})


def stateless_steps(df: DataFrame, drop_key: str = "vehicleID", keep_rows: bool = False) -> DataFrame:
    """The fixed cleaning sequence, in the reference's order: date parse,
    dedupe, door number, chronology guard, capacity mask, date parts, age,
    rate, composite, key drop, text normal form.

    ``keep_rows`` is for scoring: one row out per row in.  Copies stay, and
    the guard names its objection in ``guard_reason`` instead of dropping."""
    out = parse_dates(df, ["saleDate"])
    out = out if keep_rows else dedupe(out)
    out = to_numbers(out, ["doorNumber"])
    out = chronology_guard(out, flag=keep_rows)
    out = mask_nonpositive(out, ["cubeCapacity"])
    out = parse_dates(out, ["registrationDate"])
    out = date_parts(out)
    out = age_and_rate(out)
    out = composite(out)
    out = drop_if_present(out, [drop_key])
    return clean_text_columns(out, [c for c in string_columns(out) if c != GUARD])


def xy_split(df: DataFrame, target: str = "targetPrice", date: str = "saleDate") -> tuple[DataFrame, DataFrame]:
    """Feature columns (all but target and date) and the target column."""
    feats = [c for c in df.columns if c not in (target, date)]
    return df.select(*feats), df.select(target)


def default_column(df: DataFrame, name: str = "saleDate", value=None) -> DataFrame:
    """Add ``name`` when absent: the given value, or today's date (scoring requests
    without a sale date are scored as of now)."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.current_date() if value is None else F.lit(value))
