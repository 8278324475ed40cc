"""Date expressions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")


def parse_date(c: Column | str, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Day-first text to DATE; text that fits no format becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    tried = [F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in formats]
    return F.coalesce(*tried)


def as_date(df, name: str, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Column ``name`` of ``df`` as DATE whatever its stored type."""
    dt = df.schema[name].dataType
    if isinstance(dt, DateType):
        return F.col(name)
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.to_date(F.col(name))
    if isinstance(dt, StringType):
        return parse_date(name, formats)
    return F.lit(None).cast("date")


def age_years(start: Column | str, end: Column | str) -> Column:
    """Whole days between two dates over 365.25 (negative when start > end)."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.datediff(end, start).cast("double") / F.lit(365.25)
