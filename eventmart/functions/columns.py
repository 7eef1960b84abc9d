"""Column expressions shared by the operators. All built-in, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value) -> Column:
    """A wall-clock (TIMESTAMP_NTZ) literal, independent of the session zone."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.to_timestamp_ntz(F.lit(text))


def event_date(ts: str | Column) -> Column:
    """UTC calendar date of a timestamp (session zone is pinned to UTC)."""
    return F.to_date(col_(ts))


def clean_text(c: str | Column) -> Column:
    """Trim surrounding blanks; an empty result becomes null."""
    return F.nullif(F.trim(col_(c)), F.lit(""))


def split_part(c: str | Column, delimiter: str, n: int) -> Column:
    """n-th (1-based) piece of a delimited string; '' when out of range, null on null."""
    return F.split_part(col_(c), F.lit(delimiter), F.lit(n))


def surrogate_key(*parts: str | Column, sep: str = "-") -> Column:
    """String key from parts; null if any part is null (like ``||``)."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(col_(p).cast("string"))
    return F.concat(*pieces)


def count_where(pred: Column) -> Column:
    """Number of rows where ``pred`` is true; 0 (not null) when none match."""
    return F.count_if(pred)


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, 0.0 when den is 0 or null."""
    den_c = col_(den)
    return F.when(den_c > 0, col_(num).cast("double") / den_c).otherwise(F.lit(0.0))


def pct(c: str | Column, digits: int = 4) -> Column:
    """Percent text of a ratio column, for run reports."""
    return F.concat(F.format_number(col_(c) * 100, digits), F.lit("%"))


def thousands(c: str | Column) -> Column:
    """Integer with thousands separators, for run reports."""
    return F.format_number(col_(c), 0)
