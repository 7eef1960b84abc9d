"""Fingerprints of row multisets: equal contents, whatever the order of the rows.

Per group (a date, a layer) the number of rows and the sums of two 64-bit hashes
of whole rows, as exact decimals. Sums do not depend on order or partitioning, so
fingerprints of parts add up to that of the whole; a row changed, lost, doubled or
swapped for another changes both sums (by chance alone, once in about 2^128 cases).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT = ["n_rows", "sum_a", "sum_b"]


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """Of all columns; the flags tell rows apart that differ in which column is null."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))]).cast("decimal(38,0)")


def fingerprint(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One row per group: n_rows, sum_a, sum_b. ``columns`` (default: all) are taken in the order of their names."""
    columns = sorted(columns if columns is not None else df.columns)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.coalesce(F.sum(_row_hash(columns, seed)), F.lit(0)).cast("decimal(38,0)").alias(name) for seed, name in ((1, "sum_a"), (2, "sum_b"))])


def add_up(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The fingerprint of what several parts hold together."""
    return parts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(parts.schema[c].dataType).alias(c) for c in FINGERPRINT])


def differences(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Groups whose fingerprints differ or that one side lacks: by..., left_rows, right_rows."""
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in [*by, *FINGERPRINT]])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in [*by, *FINGERPRINT]])
    same = reduce(Column.__and__, [F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in by], F.lit(True))
    differ = reduce(Column.__or__, [~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in FINGERPRINT])
    names = [F.coalesce(F.col(f"l_{c}"), F.col(f"r_{c}")).alias(c) for c in by]
    return a.join(b, same, "full_outer").filter(differ).select(
        *names, F.coalesce("l_n_rows", F.lit(0)).alias("left_rows"), F.coalesce("r_n_rows", F.lit(0)).alias("right_rows"))
