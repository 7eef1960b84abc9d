"""Warehouse-style bulk load by column name, and the table contract check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventmart.operators.merge import partition_text
from eventmart.sinks.table import path_exists, session_conf


def project_by_name(df: DataFrame, contract: StructType) -> DataFrame:
    """Select the contract's columns from ``df`` matched case-insensitively.

    Absent columns become typed nulls, extra source columns are ignored, the
    output has the contract's names, order and types.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for field in contract.fields:
        src = by_lower.get(field.name.lower())
        expr = F.col(f"`{src}`") if src is not None else F.lit(None)
        cols.append(expr.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def load_by_name(spark: SparkSession, path: str, contract: StructType,
                 pattern: str = "*.parquet") -> DataFrame:
    """Read the data files under ``path`` whose names match ``pattern``.

    Columns are matched by name in every file: the schemas of all files are
    merged first, so a column that only some files have keeps its values, and
    files that disagree on a type fail the load, as does any unreadable file
    (no partial loads). The file-name filter keeps metadata files out of the listing.
    """
    df = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "false")
        .option("mergeSchema", "true")
        .parquet(path)
    )
    return project_by_name(df, contract)


#: partition column of a raw layer that is loaded by partitions
LOAD_PART = "load_part"


def load_partitions(spark: SparkSession, path: str, contract: StructType, partition_by: str,
                    values: Iterable[str | None] | None = None) -> DataFrame:
    """The contract's columns and ``load_part`` of a partitioned export; of its named partitions only, where given."""
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):     # values as in paths
        df = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(path)
    text = partition_text(partition_by)
    if values is not None:
        values = list(values)
        named = F.coalesce(text.isin([v for v in values if v is not None]), F.lit(False))
        df = df.filter(named | text.isNull() if None in values else named)
    return project_by_name(df.withColumn(LOAD_PART, text), StructType([*contract.fields, StructField(LOAD_PART, StringType())]))


def full_refresh(df: DataFrame, dest: str, fmt: str = "parquet", partition_by: str | None = None) -> int:
    """Truncate-then-load: the destination holds exactly ``df`` afterwards.

    The rows are written aside and counted first, then the folders are swapped by
    renames, so a load that fails leaves the rows that were there; one that died
    between the renames is put back by the next call. ``df`` may read ``dest``.
    Returns the loaded row count, read back from the files.
    """
    spark, dest = df.sparkSession, dest.rstrip("/")
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    now, aside, old = new_path(dest), new_path(f"{dest}__loading"), new_path(f"{dest}__before")
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        if not fs.exists(now):
            fs.rename(old, now)
        fs.delete(old, True)
    w = (df.hint("rebalance", partition_by) if partition_by else df).write.mode("overwrite").format(fmt)
    (w.partitionBy(partition_by) if partition_by else w).save(aside.toString())
    rows = spark.read.schema(df.schema).format(fmt).load(aside.toString()).count()
    if fs.exists(now) and not fs.rename(now, old):
        raise OSError(f"could not move {dest} aside")
    if not fs.rename(aside, now):
        raise OSError(f"could not move the new rows to {dest}")
    fs.delete(old, True)
    return rows


def refresh_partitions(df: DataFrame, dest: str, partition_by: str) -> int:
    """Replace in ``dest`` exactly the partitions that ``df`` has rows in (dynamic partition
    overwrite), loading it whole where there is no destination yet. Returns the rows loaded."""
    spark = df.sparkSession
    if not path_exists(spark, dest):
        return full_refresh(df, dest, partition_by=partition_by)
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(dest)
    return df.count()


def contract_diff(df: DataFrame, contract: StructType) -> list[str]:
    """Differences between a DataFrame and the declared contract (empty = ok)."""
    problems = []
    actual = {f.name.lower(): f for f in df.schema.fields}
    for field in contract.fields:
        got = actual.pop(field.name.lower(), None)
        if got is None:
            problems.append(f"missing column {field.name}")
        elif got.dataType != field.dataType:
            problems.append(
                f"column {field.name}: {got.dataType.simpleString()} != {field.dataType.simpleString()}"
            )
    problems.extend(f"unexpected column {name}" for name in sorted(actual))
    return problems


def check_contract(df: DataFrame, contract: StructType) -> DataFrame:
    problems = contract_diff(df, contract)
    if problems:
        raise ValueError("contract violated: " + "; ".join(problems))
    return df
