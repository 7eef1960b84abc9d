"""Single-version export of a versioned table for external loaders.

External bulk loaders list files; pointed at the versioned table they would
load superseded versions too. The export writes only the visible rows, with
plain overwrite, to a path that is never the table's own (overwriting a path
the plan reads fails), then checks that both hold the same rows, by content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators.fingerprint import differences, fingerprint
from eventmart.operators.merge import partition_text
from eventmart.sinks.table import VersionedTable, session_conf


class ExportMismatch(RuntimeError):
    pass


def export_snapshot(table: VersionedTable, dest: str, partition_by: str | None = None, only: Sequence[str] | None = None) -> int:
    """Write the visible rows to ``dest``; return their number.

    ``only``: partition values (as in paths; None for the null one); just these are read and
    replaced in ``dest``, its other partitions stay. Both sides are read back from
    their files after the write and compared per partition by fingerprint, so an export
    with other rows of equal number fails, and a task that ran twice does not.
    """
    if dest.rstrip("/") == table.root or dest.rstrip("/").startswith(table.root + "/"):
        raise ValueError("export destination must not lie inside the source table")
    current = table.read()
    part = partition_by or table.partition_by
    if only is not None:
        if not part:
            raise ValueError("a table without partitions is exported whole")
        current = _of_partitions(current, part, only)
    out = current.hint("rebalance", part) if part else current
    w = out.write.mode("overwrite")
    mode = "dynamic" if only is not None else "static"
    with session_conf(table.spark, {"spark.sql.sources.partitionOverwriteMode": mode}):
        (w.partitionBy(part) if part else w).parquet(dest)
    written = table.spark.read.schema(current.schema).parquet(dest)
    if only is not None:
        written = _of_partitions(written, part, only)
    by = [part] if part else []
    of_export = fingerprint(_as_in_paths(written, part), by)
    wrong = differences(fingerprint(_as_in_paths(current, part), by), of_export, by).limit(11).collect()
    if wrong:
        named = [tuple(r) for r in wrong[:10]]
        raise ExportMismatch(f"(partition, source rows, export rows) that differ: {named}" + (" and more" if len(wrong) > 10 else ""))
    return written.count()


def _of_partitions(df: DataFrame, part: str, values: Sequence[str | None]) -> DataFrame:
    text = partition_text(part)
    named = F.coalesce(text.isin([v for v in values if v is not None]), F.lit(False))
    return df.filter(named | text.isNull() if None in values else named)


def _as_in_paths(df: DataFrame, part: str | None) -> DataFrame:
    """A partition column reads back as its path has it: '' as null."""
    return df.withColumn(part, partition_text(part)) if part else df


def read_export(table_or_spark, dest: str) -> DataFrame:
    spark = getattr(table_or_spark, "spark", table_or_spark)
    return spark.read.parquet(dest)
