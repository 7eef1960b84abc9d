"""Grouped summaries, duplicate accounting and count reconciliation.

All single ``groupBy``/``agg`` passes: Spark runs a map-side partial
aggregate before the shuffle, so hot keys shrink to one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import col_, count_where, event_date, surrogate_key


def daily_activity(
    df: DataFrame,
    key: str,
    ts_col: str,
    type_col: str,
    type_counts: Sequence[tuple[str, str]],
    distinct_col: str,
    distinct_name: str,
    id_name: str,
    date_col: str = "event_date",
    drop_null_key: bool = True,
) -> DataFrame:
    """One row per (key, UTC date): a surrogate id, total rows, an exact
    distinct count, and one ``count_if(type = value)`` per ``type_counts``
    entry (output name, type value)."""
    src = df.filter(F.col(key).isNotNull()) if drop_null_key else df
    src = src.withColumn(date_col, event_date(ts_col)) if date_col not in src.columns else src
    aggs: list[Column] = [
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct(F.col(distinct_col)).alias(distinct_name),
    ]
    aggs += [count_where(F.col(type_col) == F.lit(v)).alias(name) for name, v in type_counts]
    out = src.groupBy(key, date_col).agg(*aggs)
    return out.select(surrogate_key(key, date_col).alias(id_name), key, date_col,
                      "total_events", distinct_name, *[n for n, _ in type_counts])


def first_last_seen(df: DataFrame, key: str, ts_col: str, date_col: str | None = None,
                    drop_null_key: bool = True) -> DataFrame:
    """Per key: first/last timestamp, first/last date, number of rows."""
    src = df.filter(F.col(key).isNotNull()) if drop_null_key else df
    d = F.col(date_col) if date_col else event_date(ts_col)
    return src.groupBy(key).agg(
        F.min(ts_col).alias("first_seen_at"),
        F.max(ts_col).alias("last_seen_at"),
        F.min(d).alias("first_seen_date"),
        F.max(d).alias("last_seen_date"),
        F.count(F.lit(1)).alias("total_events"),
    )


def rollup_span(df: DataFrame, group_cols: Sequence[str], date_col: str, count_col: str,
                first_name: str = "first_seen_date", last_name: str = "last_seen_date",
                total_name: str = "total_events") -> DataFrame:
    """Re-aggregate a (key, date) grain to a coarser one: first/last date, summed counts."""
    return df.groupBy(*group_cols).agg(
        F.min(date_col).alias(first_name),
        F.max(date_col).alias(last_name),
        F.sum(count_col).cast("bigint").alias(total_name),
    )


def duplicate_summary(df: DataFrame, key: str | Column) -> DataFrame:
    """One pass: total rows, distinct non-null keys, duplicate rows, null keys.

    duplicates = total - distinct - null_keys, so a null key is reported on
    its own instead of being counted as one more distinct value.
    """
    k = col_(key)
    counted = df.select(k.alias("_k")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.col("_k")).alias("distinct_keys"),
        count_where(F.col("_k").isNull()).alias("null_keys"),
    )
    return counted.select(
        "total", "distinct_keys",
        (F.col("total") - F.col("distinct_keys") - F.col("null_keys")).alias("duplicates"),
        "null_keys",
    )


def duplicate_report(df: DataFrame, keys: Sequence[Column], top: int | None = 10,
                     order_cols: Sequence[str] | None = None, count_name: str = "n",
                     hidden: Iterable[str] = ()) -> DataFrame:
    """Keys seen more than once, worst first; ``top`` rows when given.

    ``keys`` are aliased column expressions; ``hidden`` names grouping keys to
    drop from the output (e.g. a second digest that only guards the grouping).
    Sorting + limit plans as TakeOrderedAndProject: a per-partition top-k, no
    global sort.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    offenders = grouped.filter(F.col(count_name) > 1)
    order = [F.desc(count_name)] + [F.asc_nulls_first(c) for c in (order_cols or [])]
    offenders = offenders.orderBy(*order)
    if top is not None:
        offenders = offenders.limit(top)
    hidden = set(hidden)
    return offenders.select(*[c for c in offenders.columns if c not in hidden])


def counts_by(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def reconcile_counts(read_df: DataFrame, written_df: DataFrame, by: str,
                     read_name: str = "rows_read", written_name: str = "rows_written") -> DataFrame:
    """Per ``by`` value: rows on each side and whether they agree.

    Both sides are aggregated first (partial aggregation, then a shuffle of
    one row per value), so the full outer join only sees the small counts.
    """
    r = counts_by(read_df, by, "_r").withColumnRenamed(by, "_kr")
    w = counts_by(written_df, by, "_w").withColumnRenamed(by, "_kw")
    # null-safe: the null partition is a partition like any other
    j = r.join(w, F.col("_kr").eqNullSafe(F.col("_kw")), "full_outer")
    rc = F.coalesce(F.col("_r"), F.lit(0)).alias(read_name)
    wc = F.coalesce(F.col("_w"), F.lit(0)).alias(written_name)
    out = j.select(F.coalesce(F.col("_kr"), F.col("_kw")).alias(by), rc, wc)
    return out.withColumn("ok", F.col(read_name) == F.col(written_name))


def unknown_values(df: DataFrame, column: str, known: Iterable[str]) -> DataFrame:
    """Distinct non-null values of ``column`` outside the known set."""
    known = sorted(set(known))
    return (df.select(column)
            .filter(F.col(column).isNotNull() & ~F.col(column).isin(known))
            .distinct())


def batch_dates(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """First/last date and number of distinct dates in a batch."""
    return df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
                  F.count_distinct(date_col).alias("n_dates"))
