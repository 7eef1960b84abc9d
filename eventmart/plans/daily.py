"""One day of the lakehouse, end to end, and backfills over date ranges.

Stages, each stopping the chain on failure:
  1. ingest  -- replay the day's raw files into the landing directory;
  2. stream  -- landing -> parse -> flatten -> watermark dedup -> idempotent
               merge into the event table (availableNow, checkpointed);
  3. export  -- visible rows of the dates that the day's rows have, to a
               single-version export, then loaded by column name into the raw
               layer; other dates of both stay as they are;
  4. models  -- raw -> staging -> fact (incremental merge), data tests gate;
               the intermediate states follow the event table's commits.

Rerunning a day (fresh checkpoint, same tables) converges: the stream merge
inserts only unseen keys and the fact merges on its key. Rows that were there
already count as the day's, so a rerun also mends an export or load that died.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.operators import quality as Q
from eventmart.operators.fingerprint import fingerprint
from eventmart.plans.materialize import materialize_incremental
from eventmart.sinks.export import export_snapshot
from eventmart.sinks.replay import replay
from eventmart.session import run_together
from eventmart.sinks.table import VersionedTable, path_exists
from eventmart.sources.load import LOAD_PART, load_partitions, refresh_partitions
from eventmart.sources.messages import stream_source
from eventmart.streaming.ingest import RunMetrics, build_stream, merge_sink, run_available_now


@dataclass
class DayConfig:
    line_schema: object                   # schema of one raw JSON line (DDL or StructType)
    keys: Sequence[str]                   # event key
    ts_col: str                           # event time (TIMESTAMP)
    partition_col: str                    # table partition (UTC date)
    transform: Callable[[DataFrame], DataFrame]   # parsed -> flat
    contract: StructType                  # raw-layer columns loaded by name
    staging: Callable[[DataFrame], DataFrame] | None = None     # raw -> staging
    fact: Callable[[DataFrame, object], DataFrame] | None = None  # (staging, mark) -> fact rows
    fact_keys: Sequence[str] = ("event_id",)
    fact_mark_col: str = "event_date"
    fact_tests: Callable[[DataFrame], list] = field(default=lambda df: [])
    # full model build instead of the single fact: (spark, raw, workspace) -> dict
    models: Callable | None = None
    # keep unparseable lines (raw text) for the quarantine table
    corrupt_col: str | None = None
    watermark: str = "26 hours"
    files_per_trigger: int = 1


@dataclass
class DayResult:
    sent: int
    stream: RunMetrics
    exported: int
    loaded: int
    fact_version: int
    warnings: list


class Workspace:
    """Folder layout of one lakehouse under a shared root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.landing = f"{self.root}/landing"
        self.events = f"{self.root}/tables/events"
        self.quarantine = f"{self.root}/tables/quarantine"
        self.export = f"{self.root}/export/events"
        self.raw = f"{self.root}/warehouse/raw_events"
        self.fact = f"{self.root}/tables/fct_events"

    def checkpoint(self, run_id: str) -> str:
        return f"{self.root}/checkpoints/{run_id}"


def land_day(spark: SparkSession, raw_paths: Sequence[str], ws: Workspace, run_id: str) -> int:
    """Replay the day's raw files into its own landing folder; the number of lines."""
    return replay(spark, raw_paths, f"{ws.landing}/{run_id}")    # an absent hour stops the day here


def run_day(spark: SparkSession, raw_paths: Sequence[str], ws: Workspace, cfg: DayConfig,
            run_id: str, sent: int | None = None) -> DayResult:
    """``sent``: the day has landed already (``land_day``), with so many lines."""
    sent = land_day(spark, raw_paths, ws, run_id) if sent is None else sent

    events = VersionedTable(spark, ws.events, partition_by=cfg.partition_col)
    quarantine = VersionedTable(spark, ws.quarantine, partition_by=None)
    raw = stream_source(spark, "files", path=f"{ws.landing}/{run_id}", cap=cfg.files_per_trigger)
    stream = build_stream(raw, cfg.line_schema, cfg.keys, cfg.ts_col, cfg.transform, cfg.watermark,
                          corrupt_col=cfg.corrupt_col)
    sink = merge_sink(events, cfg.keys, quarantine, corrupt_col=cfg.corrupt_col)
    metrics = run_available_now(spark, stream, sink,
                                ws.checkpoint(run_id), table=events, watermark=cfg.watermark)

    touched = sorted(sink.touched, key=lambda v: (v is None, v)) if path_exists(spark, ws.raw) else None
    exported = export_snapshot(events, ws.export, only=touched)
    loaded = refresh_partitions(load_partitions(spark, ws.export, cfg.contract, cfg.partition_col, touched), ws.raw, LOAD_PART)

    raw_df = spark.read.parquet(ws.raw)
    if cfg.models is not None:
        built = cfg.models(spark, raw_df, ws)
        return DayResult(sent, metrics, exported, loaded, built["versions"]["fct_events"],
                         built["warnings"])
    staging = cfg.staging(raw_df)
    fact = VersionedTable(spark, ws.fact, partition_by=cfg.partition_col)
    version = materialize_incremental(lambda mark: cfg.fact(staging, mark), fact,
                                      cfg.fact_keys, cfg.fact_mark_col)
    warnings = Q.gate(Q.run_tests(fact.read(), cfg.fact_tests(fact.read())))
    return DayResult(sent, metrics, exported, loaded, version, warnings)


def event_day_config(files_per_trigger: int = 4) -> DayConfig:
    """The day of the public event archive: nested JSON lines, flattened,
    26-hour watermark dedup on event_id, full warehouse build with tests."""
    from eventmart.operators.flatten import flatten
    from eventmart.plans.warehouse import Warehouse, build_models
    from eventmart.schema import CORRUPT_COLUMN, event_schema, events_contract

    return DayConfig(
        line_schema=event_schema(), keys=["event_id"], ts_col="created_at",
        partition_col="event_date", transform=lambda df: flatten(df, keep=[CORRUPT_COLUMN]),
        contract=events_contract(), corrupt_col=CORRUPT_COLUMN,
        models=lambda spark, raw, ws: build_models(spark, raw, Warehouse(f"{ws.root}/warehouse"), source=VersionedTable(spark, ws.events)),
        files_per_trigger=files_per_trigger)


def layer_counts(spark: SparkSession, ws: Workspace, key: str) -> DataFrame:
    """Per layer: rows, distinct keys and the fingerprint of its rows (the reprocess proof)."""
    parts = []
    for name, path in (("table", ws.events), ("fct", ws.fact)):
        df = VersionedTable(spark, path).read()
        keys = df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"))
        parts.append(keys.join(fingerprint(df).select("sum_a", "sum_b")))       # one row each
    return parts[0].unionByName(parts[1])


def day_range(start: str, end: str) -> list[str]:
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(a + dt.timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def backfill(spark: SparkSession, days: Sequence[str], paths_for_day: Callable[[str], list[str]],
             ws: Workspace, cfg: DayConfig, one_pass: bool = False, at_once: int = 4) -> list[DayResult]:
    """Run days in date order; a failing day stops the backfill.

    The days' replays are independent of each other and run together, up to
    ``at_once``, each in a scheduler pool of its own; what merges into shared tables
    (stream, export, models) then runs one day at a time. ``one_pass``: all days go
    through one replay job, one stream run (its files still in date order), one export
    and one model build. Both give the same tables.
    """
    ordered = sorted(days)
    if one_pass:
        paths = [p for d in ordered for p in paths_for_day(d)]
        return [run_day(spark, paths, ws, cfg, run_id=f"days-{ordered[0]}-{ordered[-1]}")]
    sent = run_together(spark, [partial(land_day, spark, paths_for_day(d), ws, f"day-{d}") for d in ordered], at_once)
    return [run_day(spark, paths_for_day(d), ws, cfg, f"day-{d}", n) for d, n in zip(ordered, sent, strict=True)]


def reconcile_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two runs of the same day: per layer, the same rows (by count, keys and fingerprint)?"""
    facts = [c for c in before.columns if c != "layer"]
    b = before.select("layer", *[F.col(c).alias(f"{c}_before") for c in facts])
    a = after.select("layer", *[F.col(c).alias(f"{c}_after") for c in facts])
    same = reduce(Column.__and__, [F.col(f"{c}_before") == F.col(f"{c}_after") for c in facts])
    return b.join(a, "layer", "full_outer").withColumn("ok", F.coalesce(same, F.lit(False)))
