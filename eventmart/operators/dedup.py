"""One row per key: latest or first by an ordering with tie-breakers.

Written as a grouped ``max_by``/``min_by`` over a row struct rather than
``row_number() over (partition by k order by ...) = 1``: the aggregate has a
map-side partial step, so a key holding a third of all rows collapses to one
row per input partition before the shuffle instead of being sorted whole in
one task. Rows whose ordering value is null never win (nulls sort last in
both directions), and the ordering struct carries the tie-breakers so the
pick is deterministic when they make the ordering unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_struct(order_by: Sequence[str], latest: bool) -> Column:
    parts: list[Column] = []
    for i, c in enumerate(order_by):
        # For max_by a present value must beat null; for min_by a present value
        # must come before null.
        flag = F.col(c).isNotNull() if latest else F.col(c).isNull()
        parts.append(flag.alias(f"_n{i}"))
        parts.append(F.col(c).alias(f"_v{i}"))
    return F.struct(*parts)


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in payload])
    ordering = _order_struct(order_by, latest)
    chooser = F.max_by if latest else F.min_by
    picked = df.groupBy(*keys).agg(chooser(row, ordering).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Row with the greatest (order_by...) per key; all columns kept."""
    return _pick(df, keys, order_by, latest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Row with the smallest (order_by...) per key; all columns kept (grain enforcement)."""
    return _pick(df, keys, order_by, latest=False)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)
