"""Batch ingest of raw event files into the partitioned event table.

read (declared schema) -> flatten -> stage -> gates -> replace the touched
dates -> reconcile. The raw files are parsed once, into a staged table beside
the target; the gates, the write and the reconciliation read that. Rerunning
the same input replaces its dates instead of appending a second copy. Gates:

* no rows with a date -> error (nothing to write, likely a wrong glob);
* rows with a null date are routed to a quarantine table and fail the run
  above ``max_null_date_rate`` (they could never be matched by the
  replace filter); the quarantine is partitioned by the batch they came with,
  so a rerun replaces them as well;
* event types outside the known set -> error, naming up to ``limit`` of them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.aggregates import counts_by, reconcile_counts, unknown_values
from eventmart.operators.fingerprint import fingerprint
from eventmart.operators.flatten import flatten
from eventmart.schema import KNOWN_EVENT_TYPES
from eventmart.sinks.table import VersionedTable, delete_path
from eventmart.sources.files import read_events


#: partition column of the quarantine: the input a row came with
BATCH = "batch"


class IngestError(RuntimeError):
    pass


@dataclass
class IngestResult:
    rows_read: int
    null_dates: int
    first_date: object
    last_date: object
    n_dates: int
    version: int
    rows_written: int


def check_known_types(flat: DataFrame, type_col: str, known: Iterable[str], limit: int = 100) -> None:
    found = [r[0] for r in unknown_values(flat, type_col, known).limit(limit + 1).collect()]
    if found:
        more = " and more" if len(found) > limit else ""
        raise IngestError(f"{type_col} holds values that the schema does not declare: {sorted(found)[:limit]}{more}")


def ingest_batch(spark: SparkSession, paths, table: VersionedTable,
                 quarantine: VersionedTable | None = None, date_col: str = "event_date",
                 type_col: str = "event_type", known_types: Iterable[str] = KNOWN_EVENT_TYPES,
                 max_null_date_rate: float = 0.0, flat: DataFrame | None = None,
                 batch: str | None = None) -> IngestResult:
    """``batch`` names the input, for the quarantine: by default its paths, or, of given rows,
    their fingerprint."""
    flat = flat if flat is not None else flatten(read_events(spark, paths))
    stage = f"{table.root}/_staging/{uuid.uuid4().hex}"
    flat.write.parquet(stage)
    try:
        staged = spark.read.schema(flat.schema).parquet(stage)
        if quarantine is not None and batch is None:
            named = [paths] if isinstance(paths, str) else sorted(paths or [])
            batch = "\n".join(named) if named else "-".join(str(x) for x in fingerprint(staged).first())
            batch = hashlib.sha256(batch.encode()).hexdigest()
        return _ingest_staged(staged, table, quarantine, date_col, type_col, known_types, max_null_date_rate, batch)
    finally:
        delete_path(spark, stage)


def _replace_quarantined(quarantine: VersionedTable, rows: DataFrame, n: int, batch: str) -> None:
    """The quarantine's rows of this batch are these, whatever an earlier run of it left."""
    if not quarantine.exists():
        quarantine = VersionedTable(quarantine.spark, quarantine.root, partition_by=BATCH)
        if not n:
            return
    elif quarantine.partition_by != BATCH:
        raise ValueError(f"the quarantine {quarantine.root} is not partitioned by {BATCH}")
    quarantine.replace_among(rows.withColumn(BATCH, F.lit(batch)), [batch])


def _ingest_staged(flat: DataFrame, table: VersionedTable, quarantine: VersionedTable | None, date_col: str,
                   type_col: str, known_types: Iterable[str], max_null_date_rate: float, batch: str | None) -> IngestResult:
    dated = flat.filter(F.col(date_col).isNotNull())
    per_date = counts_by(flat, date_col).collect()      # a row per date of the batch
    rows = sum(r["n"] for r in per_date)
    dates = sorted(r[date_col] for r in per_date if r[date_col] is not None)
    null_dates = sum(r["n"] for r in per_date if r[date_col] is None)
    if not dates:
        raise IngestError("no rows with a date were read; check the input paths")
    if quarantine is not None:
        _replace_quarantined(quarantine, flat.filter(F.col(date_col).isNull()), null_dates, batch)
    if null_dates:
        if null_dates > max_null_date_rate * rows:
            raise IngestError(f"{null_dates} of {rows} rows have no {date_col}")
    check_known_types(dated, type_col, known_types)

    version = table.replace_partitions(dated)
    written = table.read().filter(F.col(date_col).between(dates[0], dates[-1]))
    check = reconcile_counts(dated, written.join(dated.select(date_col).distinct(), date_col, "left_semi"), date_col)
    bad = check.filter(~F.col("ok")).limit(11).collect()
    if bad:
        raise IngestError(f"row count mismatch on {[(r[date_col], r['rows_read'], r['rows_written']) for r in bad[:10]]}"
                          + (" and more" if len(bad) > 10 else ""))
    return IngestResult(rows, null_dates, dates[0], dates[-1], len(dates), version, rows - null_dates)
