"""Slowly changing dimension, type 2, ``check`` strategy.

A snapshot run compares the open history rows with the current state on the
key: a changed row is closed at the snapshot time and a new version opened;
a new key opens a row; a key missing from the current state stays open.
One full outer join of open rows against the current state (both sides
shuffle on the key), then each joined row emits one or two history rows
through ``explode`` -- a single pass, no self-union of the join. ``next_rows``
gives only what a run writes: the open rows, and the rows it closes. Closed rows
of earlier runs are never read, so a table partitioned by ``is_open`` appends to its
closed partition and rewrites the open one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import ntz
from eventmart.sinks.table import VersionedTable

VALID_FROM, VALID_TO, UPDATED_AT, SCD_ID = "valid_from", "valid_to", "updated_at", "scd_id"
IS_OPEN = "is_open"
HISTORY_COLUMNS = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]


def _ts(value):
    return ntz(value)


def _scd_id(key: str, ts_col) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), ts_col.cast("string")))


def open_history(current: DataFrame, key: str, snapshot_ts) -> DataFrame:
    """First snapshot: every current row opens at ``snapshot_ts``."""
    ts = _ts(snapshot_ts)
    return current.select(
        *current.columns,
        _scd_id(key, ts).alias(SCD_ID), ts.alias(UPDATED_AT), ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def snapshot(history: DataFrame | None, current: DataFrame, key: str,
             check_cols: Sequence[str], snapshot_ts) -> DataFrame:
    """New full history after comparing ``current`` with ``history``."""
    if history is None:
        return open_history(current, key, snapshot_ts)
    rows = next_rows(history.filter(F.col(VALID_TO).isNull()), current, key, check_cols, snapshot_ts)
    return history.filter(F.col(VALID_TO).isNotNull()).select(*rows.columns).unionByName(rows)


def next_rows(opened: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], snapshot_ts) -> DataFrame:
    """The open rows after comparing ``current`` with the open rows before, and those now closed."""
    ts = _ts(snapshot_ts)
    attrs = [c for c in current.columns if c != key]
    h = opened.select(key, *[F.col(c).alias(f"h_{c}") for c in attrs + HISTORY_COLUMNS])
    c = current.select(key, *[F.col(a).alias(f"c_{a}") for a in attrs], F.lit(True).alias("_cur"))
    j = h.join(c, key, "full_outer")
    has_h = F.col(f"h_{VALID_FROM}").isNotNull()
    has_c = F.col("_cur").isNotNull()
    changed = has_h & has_c & _differs(check_cols)

    out_cols = [key] + attrs + HISTORY_COLUMNS
    old_row = F.struct(
        F.col(key).alias(key),
        *[F.col(f"h_{a}").alias(a) for a in attrs],
        F.col(f"h_{SCD_ID}").alias(SCD_ID),
        F.when(changed, ts).otherwise(F.col(f"h_{UPDATED_AT}")).alias(UPDATED_AT),
        F.col(f"h_{VALID_FROM}").alias(VALID_FROM),
        F.when(changed, ts).otherwise(F.col(f"h_{VALID_TO}")).alias(VALID_TO),
    )
    new_row = F.struct(
        F.col(key).alias(key),
        *[F.col(f"c_{a}").alias(a) for a in attrs],
        _scd_id(key, ts).alias(SCD_ID), ts.alias(UPDATED_AT), ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )
    rows = F.array(
        F.when(has_h, old_row),
        F.when(has_c & (~has_h | changed), new_row),
    )
    emitted = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("_r")).select("_r.*")
    return emitted.select(*out_cols)


def snapshot_table(table: VersionedTable, current: DataFrame, key: str, check_cols: Sequence[str], snapshot_ts) -> int:
    """Take the snapshot into a table partitioned by ``is_open``: one commit adds the rows that this
    run closes and replaces the open ones. Closed rows of earlier runs are neither read nor written."""
    if not table.exists():
        return table.append(open_history(current, key, snapshot_ts).withColumn(IS_OPEN, F.lit(True)))
    before = table.read()
    opened = before.filter(F.col(IS_OPEN)).drop(IS_OPEN)
    rows = next_rows(opened, current, key, check_cols, snapshot_ts)
    return table.replace_among(rows.withColumn(IS_OPEN, F.col(VALID_TO).isNull()).select(*before.columns), ["true"])


def _differs(check_cols: Sequence[str]):
    cond = F.lit(False)
    for col in check_cols:
        cond = cond | ~F.col(f"h_{col}").eqNullSafe(F.col(f"c_{col}"))
    return cond


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO).isNull())
