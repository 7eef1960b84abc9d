"""High-water-mark incremental selection.

The mark (``max`` of a column over the loaded target) is computed first as a
scalar -- one aggregated row, a bounded collect -- and then used as a literal
filter, so it reaches the scan as a pushed / partition-pruning predicate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame | None, column: str):
    """``max(column)`` over the target; None for a missing or empty target."""
    if target is None:
        return None
    return target.agg(F.max(column).alias("m")).collect()[0]["m"]


def _shifted(mark, lookback_days: int):
    if not lookback_days:
        return mark
    if isinstance(mark, (dt.date, dt.datetime)):
        return mark - dt.timedelta(days=lookback_days)
    return mark - lookback_days


def after_mark(source: DataFrame, column: str | Column, mark, lookback_days: int = 0) -> DataFrame:
    """Rows strictly after the mark (optionally re-reading ``lookback_days``).

    A null mark (nothing loaded yet, or an existing but empty target) loads
    everything rather than nothing.
    """
    if mark is None:
        return source
    c = F.col(column) if isinstance(column, str) else column
    return source.filter(c > F.lit(_shifted(mark, lookback_days)))


def groups_after_mark(aggregated: DataFrame, column: str, mark, lookback_days: int = 0) -> DataFrame:
    """HAVING form: keep groups whose aggregate ``column`` passes the mark."""
    return after_mark(aggregated, column, mark, lookback_days)
