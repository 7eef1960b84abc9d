"""Key-based merges as joins: insert-only, upsert, partition replace, delete.

Pure DataFrame -> DataFrame. No size is guessed here: the joins carry no hints,
so Spark broadcasts a side whose measured size is small and otherwise shuffles
both on the key, splitting skewed partitions (AQE). The batch's keys are matched
against the target first, so that a small batch streams the target past it
without a shuffle of the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_keys(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, failing while it runs on the first row with a null key (no extra job)."""
    keys = list(keys)
    fail = F.raise_error(F.lit(f"merge batch holds a null key on {keys}; split it off first")).cast("boolean")
    return df.filter(F.when(not_null_keys(keys), F.lit(True)).otherwise(fail))


def merge_insert_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                      batch_unique: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (one row per key).

    The batch is deduplicated on the key first, so a batch holding the same
    new key twice inserts it once; ``batch_unique`` skips that shuffle when the
    batch is already key-unique (a stream deduplicated on the key). A null key
    fails the merge: it could never match, so every replay would insert it again.
    """
    keys = list(keys)
    present = require_keys(batch, keys)
    deduped = present if batch_unique else present.dropDuplicates(keys)
    matched = target.select(*keys).join(batch.select(*keys), keys, "left_semi").distinct()
    return deduped.join(matched, keys, "left_anti")


def merge_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only merge: matched keys keep the target row, others are added."""
    return target.unionByName(merge_insert_rows(target, batch, keys))


def check_upsert_batch(batch: DataFrame, keys: Sequence[str]) -> int:
    """One pass over the batch's keys: none is null, none occurs twice; their number."""
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ok = not_null_keys(keys)
    nulls, repeated, rows = per_key.agg(F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)),
                                        F.count_if(ok & (F.col("n") > 1)), F.count(F.lit(1))).first()
    if nulls:
        raise ValueError(f"upsert batch holds a null key on {list(keys)}")
    if repeated:
        raise ValueError(f"merge source holds a key more than once on {list(keys)}")
    return rows


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           check_batch: bool = True) -> DataFrame:
    """Upsert: a matched key gets the batch row (all columns), others are inserted.

    The batch must hold each key once and no null key (checked unless
    ``check_batch=False``, when the caller has checked it).
    """
    keys = list(keys)
    if check_batch:
        check_upsert_batch(batch, keys)
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def partition_text(part_col: str) -> Column:
    """A partition value as Spark writes it in a path: its text, and null for
    an empty string, which a partitioned table cannot tell from null."""
    return F.nullif(F.col(part_col).cast("string"), F.lit(""))


def partition_values(df: DataFrame, part_col: str) -> tuple[list[str], bool]:
    """Distinct partition values of a batch as text and whether it holds nulls.

    One entry per partition written, which is what the table lists on the
    driver anyway; rows never get here.
    """
    vals = [r[0] for r in df.select(partition_text(part_col)).distinct().collect()]
    return sorted(v for v in vals if v is not None), None in vals


def touched_predicate(part_col: str, values: list[str], has_null: bool) -> Column:
    """Rows in one of the partitions (or in the null one, when the batch held
    nulls); never null itself, so its negation keeps null-partition rows the
    batch does not touch."""
    text = partition_text(part_col)
    cond = F.coalesce(text.isin(values), F.lit(False)) if values else F.lit(False)
    return cond | text.isNull() if has_null else cond


def replace_where(target: DataFrame, batch: DataFrame, part_col: str) -> DataFrame:
    """Replace exactly the partitions the batch touches; keep all others."""
    touched = batch.select(partition_text(part_col).alias("_touched")).distinct()
    keep = target.join(touched, partition_text(part_col).eqNullSafe(F.col("_touched")), "left_anti")
    return keep.unionByName(batch)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Remove rows where ``predicate`` is true; null counts as not matched."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))
