"""Driver queries that go through storage: the versioned table, exports,
bulk loads and streams. Each run works in a fresh folder under the shared
checkpoint root and returns a DataFrame read back from what was written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.functions.columns import clean_text, event_date
from eventmart.operators import dedup as D
from eventmart.operators import quality as Q
from eventmart.operators.asof import as_of, history
from eventmart.plans.catalog import events, register, table
from eventmart.plans.daily import DayConfig, Workspace, layer_counts, reconcile_runs, run_day
from eventmart.plans.materialize import materialize_incremental
from eventmart.schema import CORRUPT_COLUMN
from eventmart.session import scratch_path
from eventmart.sinks.export import export_snapshot, read_export
from eventmart.sinks.replay import replay, write_segments
from eventmart.sinks.table import VersionedTable, list_subdirs
from eventmart.sources.load import full_refresh, load_by_name
from eventmart.sources.messages import stream_source
from eventmart.streaming.ingest import build_stream, merge_sink, metrics_frame, run_available_now

JAN = {d: dt.date(2024, 1, d) for d in range(1, 32)}

# Stream line schema: event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ).
STREAM_LINE_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _dated(spark, sf_dir, *cols):
    return events(spark, sf_dir).select(*cols, event_date("ts").alias("event_date"))


# ------------------------------------------------------------ versioned table
@register("replace_where", """
select event_id, cast(ts as date) event_date, user_id from events
where cast(ts as date) not in (date '2024-01-10', date '2024-01-11') or event_id % 2 = 0""")
def q_replace_where(spark, sf_dir):
    t = VersionedTable(spark, scratch_path(spark, "replace_where"), partition_by="event_date")
    ev = _dated(spark, sf_dir, "event_id", "user_id")
    t.append(ev)
    batch = ev.filter(F.col("event_date").isin(JAN[10], JAN[11]) & (F.col("event_id") % 2 == 0))
    t.replace_partitions(batch)
    t.replace_partitions(batch)   # rerun of the same batch replaces, never doubles
    return t.read().select("event_id", "event_date", "user_id")


def _orders_by_year(spark, sf_dir):
    """The orders as versioned rows: one version per order year."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.year("o_orderdate") - 1995).cast("int").alias("version"))


@register("as_of_version", """
select o_orderkey, cast(year(o_orderdate) - 1995 as int) as version from orders where year(o_orderdate) - 1995 <= 3""")
def q_as_of_version(spark, sf_dir):
    return as_of(_orders_by_year(spark, sf_dir), 3)


@register("table_history", """
select cast(year(o_orderdate) - 1995 as int) as version, count(*) num_output_rows from orders group by 1 order by 1""")
def q_table_history(spark, sf_dir):
    return history(_orders_by_year(spark, sf_dir))


def _replaced_rows(spark, sf_dir):
    """Versioned rows: all events as version 1, then a part of 5 January that
    replaces that day as version 2; and the table of replacements."""
    ev = _dated(spark, sf_dir, "event_id")
    batch = ev.filter((F.col("event_date") == JAN[5]) & (F.col("event_id") % 3 == 0))
    rows = ev.withColumn("version", F.lit(1)).unionByName(batch.withColumn("version", F.lit(2)))
    replaced = batch.select(F.lit(2).alias("version"), F.col("event_date").alias("part")).distinct()
    return rows, replaced


@register("as_of_before_replace", "select event_id, cast(ts as date) event_date from events")
def q_as_of_before_replace(spark, sf_dir):
    rows, replaced = _replaced_rows(spark, sf_dir)
    return as_of(rows, 1, part_col="event_date", replaced=replaced).drop("version")


def _appended_then_replaced(spark, sf_dir, name):
    ev = _dated(spark, sf_dir, "event_id")
    t = VersionedTable(spark, scratch_path(spark, name), partition_by="event_date")
    t.append(ev)
    t.replace_partitions(ev.filter((F.col("event_date") == JAN[5]) & (F.col("event_id") % 3 == 0)))
    return t


REPLACED_JAN5 = """
select event_id, cast(ts as date) event_date from events where cast(ts as date) <> date '2024-01-05' or event_id % 3 = 0"""


@register("snapshot_export", REPLACED_JAN5)
def q_snapshot_export(spark, sf_dir):
    t = _appended_then_replaced(spark, sf_dir, "snapshot_export")
    dest = scratch_path(spark, "snapshot_export_out")
    export_snapshot(t, dest)
    export_snapshot(t, dest)   # a repeated export replaces, never accumulates
    return read_export(spark, dest).select("event_id", "event_date")


@register("expire_versions", REPLACED_JAN5)
def q_expire_versions(spark, sf_dir):
    """What is left once superseded rows are dropped: the latest snapshot."""
    rows, replaced = _replaced_rows(spark, sf_dir)
    return as_of(rows, 2, part_col="event_date", replaced=replaced).drop("version")


@register("replace_where_typed", """
select 'boolean' kind, event_id from events where event_id % 3 <> 0 or event_id % 2 = 0
union all select 'double', event_id from events where event_id % 3 <> 0 or event_id % 2 = 0
union all select 'text', event_id from events where event_id % 3 <> 0 or event_id % 2 = 0
union all select 'timestamp', event_id from events where event_id % 3 <> 0 or event_id % 2 = 0""")
def q_replace_where_typed(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id")
    turn = F.col("event_id") % 3
    kinds = {"boolean": turn == 0, "double": turn / 2.0,
             "text": F.when(turn == 0, "").when(turn == 1, "a b").otherwise("x/y"),
             "timestamp": F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00.25")) + F.make_interval(secs=turn)}
    out = None
    for kind, value in sorted(kinds.items()):
        t = VersionedTable(spark, scratch_path(spark, f"replace_{kind}"), partition_by="part")
        rows = ev.withColumn("part", value)
        t.append(rows)
        batch = rows.filter((turn == 0) & (F.col("event_id") % 2 == 0))
        t.replace_partitions(batch)
        t.replace_partitions(batch)
        part = t.read().select(F.lit(kind).alias("kind"), "event_id")
        out = part if out is None else out.unionByName(part)
    return out


LOAD_CONTRACT = "event_id BIGINT, user_id BIGINT, event_type STRING, note STRING"


@register("load_by_name", "select event_id, user_id, event_type, cast(null as varchar) note from events")
def q_load_by_name(spark, sf_dir):
    src = scratch_path(spark, "load_src")
    ev = events(spark, sf_dir)
    # upper-cased, shuffled, one contract column (note) absent, one extra
    ev.select(F.col("event_type").alias("EVENT_TYPE"), F.col("value").alias("VALUE"),
              F.col("user_id").alias("User_Id"), F.col("event_id").alias("EVENT_ID")) \
        .write.parquet(src)
    dest = scratch_path(spark, "load_dest")
    contract = StructType.fromDDL(LOAD_CONTRACT)
    full_refresh(load_by_name(spark, src, contract), dest)
    full_refresh(load_by_name(spark, src, contract), dest)   # rerun: truncate + load
    return spark.read.parquet(dest)


@register("load_by_name_mixed_files", """
select event_id, user_id, event_type, case when event_id % 2 = 1 then 'note ' || event_id end note from events""")
def q_load_by_name_mixed_files(spark, sf_dir):
    """Files of two schemas in one folder: only some hold the column note."""
    src = scratch_path(spark, "load_mixed")
    ev = events(spark, sf_dir).select("event_id", "user_id", "event_type")
    ev.filter(F.col("event_id") % 2 == 0).write.parquet(src)
    ev.filter(F.col("event_id") % 2 == 1).withColumn("NOTE", F.concat(F.lit("note "), F.col("event_id"))) \
        .write.mode("append").parquet(src)
    return load_by_name(spark, src, StructType.fromDDL(LOAD_CONTRACT))


@register("fct_first_build", """
with e as (select event_id, ts, user_id from events union all select event_id, ts, user_id from events where event_id % 9 = 0)
select event_id, ts, user_id from e qualify row_number() over (partition by event_id order by ts) = 1""")
def q_fct_first_build(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id")
    staged = ev.unionByName(ev.filter(F.col("event_id") % 9 == 0)) \
        .withColumn("event_date", event_date("ts"))
    fct = VersionedTable(spark, scratch_path(spark, "fct_first_build"), partition_by="event_date")

    def build(mark):
        fresh = staged if mark is None else staged.filter(F.col("event_date") > F.lit(mark))
        return D.first_per_key(fresh, ["event_id"], ["ts", "user_id"])

    materialize_incremental(build, fct, ["event_id"], "event_date")   # target missing: create
    return fct.read().select("event_id", "ts", "user_id")


# -------------------------------------------------------------------- streams
# ISO-8601 with microseconds (the JSON writer's default keeps milliseconds only)
LINE_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _line(ev: DataFrame):
    return F.to_json(F.struct(*[F.col(c) for c in ev.columns if not c.startswith("_")]), LINE_OPTIONS)


def _stream_days(spark, sf_dir, name, extra_copies=None):
    """The events as stream delivery files, delivered one UTC day after the
    other. A day spans less than the 26-hour watermark, so however its files
    are split over micro-batches, no row is judged late."""
    ev = events(spark, sf_dir)
    src = ev if extra_copies is None else ev.unionByName(extra_copies(ev))
    path = scratch_path(spark, name)
    lines = src.select(event_date("ts").alias("_seg"), _line(ev).alias("value"))
    write_segments(lines, path, "_seg")
    return path


def _stream_output(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"),
                     event_date("ts").alias("event_date"), *[c for c in df.columns if c == CORRUPT_COLUMN])


def _ingest(spark, landing, root, cap=10, delay="26 hours"):
    """One run of the stream over a landing folder; everything lives under root."""
    t = VersionedTable(spark, f"{root}/table", partition_by="event_date")
    q = VersionedTable(spark, f"{root}/quarantine")
    raw = stream_source(spark, "files", path=landing, cap=cap)
    stream = build_stream(raw, STREAM_LINE_SCHEMA, ["event_id"], "ts", delay=delay, corrupt_col=CORRUPT_COLUMN)
    sink = merge_sink(t, ["event_id"], q, output=_stream_output, corrupt_col=CORRUPT_COLUMN)
    return t, q, run_available_now(spark, stream, sink, f"{root}/checkpoint", table=t, watermark=delay)


STREAM_ORACLE = "select event_id, user_id, event_type, ts from events"


@register("stream_dedup_merge", STREAM_ORACLE)
def q_stream_dedup_merge(spark, sf_dir):
    landing = _stream_days(spark, sf_dir, "dedup_landing",
                           extra_copies=lambda ev: ev.filter(F.col("event_id") % 3 == 0))
    t, _, _ = _ingest(spark, landing, scratch_path(spark, "dedup"))
    return t.read().select("event_id", "user_id", "event_type", "ts")


@register("stream_restart", STREAM_ORACLE)
def q_stream_restart(spark, sf_dir):
    """Two runs on one checkpoint: the second takes up only what landed since."""
    ev = events(spark, sf_dir)
    landing, root = scratch_path(spark, "restart_landing"), scratch_path(spark, "restart")
    day = event_date("ts")
    middle = ev.agg(F.expr("percentile_approx(unix_date(to_date(ts)), 0.5)").alias("d")).first()["d"]
    lines = ev.select(day.alias("_seg"), F.unix_date(day).alias("_day"), _line(ev).alias("value"))
    write_segments(lines.filter(F.col("_day") <= middle).drop("_day"), landing, "_seg")
    _ingest(spark, landing, root)
    write_segments(lines.filter(F.col("_day") > middle).drop("_day"), landing, "_seg")
    t, _, _ = _ingest(spark, landing, root)
    return t.read().select("event_id", "user_id", "event_type", "ts")


@register("stream_quarantine", """
select count(*) input_rows, count(*) filter (where event_id % 11 = 0 or event_id % 13 = 0) quarantined,
       count(*) filter (where event_id % 11 <> 0 and event_id % 13 <> 0) inserted from events""")
def q_stream_quarantine(spark, sf_dir):
    """Cut lines (every 11th) and null keys (every 13th) end in the quarantine,
    counted; the table and the quarantine are counted from their rows."""
    ev = events(spark, sf_dir)
    keyed = ev.withColumn("_id", F.col("event_id")) \
        .withColumn("event_id", F.when(F.col("_id") % 13 != 0, F.col("_id")))
    lines = keyed.select(event_date("ts").alias("_seg"), _line(ev).alias("value"), "_id")
    value = F.when(F.col("_id") % 11 == 0, F.expr("substr(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    landing = scratch_path(spark, "quarantine_landing")
    write_segments(lines.select("_seg", value.alias("value")), landing, "_seg")
    t, q, m = _ingest(spark, landing, scratch_path(spark, "quarantine"))
    counted = t.read().agg(F.count(F.lit(1)).alias("inserted")).join(q.read().agg(F.count(F.lit(1)).alias("quarantined")))
    return counted.select(metrics_input(spark, m), "quarantined", "inserted")


def metrics_input(spark, m):
    return F.lit(m.input_rows).cast("long").alias("input_rows")


@register("stream_same_key_two_dates", STREAM_ORACLE)
def q_stream_same_key_two_dates(spark, sf_dir):
    """Every fifth event comes again under a date 40 days on, past the
    watermark: the table keeps one row per key, the first."""
    landing = _stream_days(
        spark, sf_dir, "two_dates_landing",
        extra_copies=lambda ev: ev.filter(F.col("event_id") % 5 == 0)
        .withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAYS")))
    t, _, _ = _ingest(spark, landing, scratch_path(spark, "two_dates"))
    return t.read().select("event_id", "user_id", "event_type", "ts")


@register("late_rate", """
with n as (select count(*) n, count(*) filter (where event_id % 4 = 0
             and cast(ts as date) = (select min(cast(ts as date)) from events)) late from events)
select n + late input_rows, late dropped, late / (n + late) late_rate from n""")
def q_late_rate(spark, sf_dir):
    """All days in order, then late copies of the first day under new ids."""
    ev = events(spark, sf_dir).withColumn("_seg", event_date("ts"))
    ends = ev.agg(F.min("_seg"), F.max("_seg")).first()
    late = ev.filter((F.col("_seg") == F.lit(ends[0])) & (F.col("event_id") % 4 == 0)) \
        .withColumn("event_id", -F.col("event_id") - 1).withColumn("_seg", F.lit(ends[1] + dt.timedelta(days=1)))
    lines = ev.unionByName(late).select("_seg", _line(ev).alias("value"))
    landing = scratch_path(spark, "late_landing")
    write_segments(lines, landing, "_seg")
    _, _, m = _ingest(spark, landing, scratch_path(spark, "late"), delay="1 day")
    return metrics_frame(spark, m).select("input_rows", F.col("dropped_by_watermark").alias("dropped"),
                                          F.col("late_event_rate").alias("late_rate"))


def blanks_expr():
    """A blank line ('' or spaces and a tab) for the adverse replay archive."""
    return F.when(F.col("event_id") % 8 == 0, F.lit("")).otherwise(F.lit("   \t ")).alias("value")


def _archive(spark, sf_dir, name):
    """The events as an archive of raw lines, one folder per day, blank lines mixed in."""
    ev = events(spark, sf_dir)
    archive = scratch_path(spark, name)
    keyed = [event_date("ts").alias("day"), "event_id"]
    lines = ev.select(*keyed, F.concat(F.lit(" "), _line(ev), F.lit("\t")).alias("value")).unionByName(
        ev.filter(F.col("event_id") % 4 == 0).select(*keyed, blanks_expr()))
    # one file a day, its lines by id
    lines.repartition("day").sortWithinPartitions("day", "event_id").drop("event_id").write.partitionBy("day").text(archive)
    return list_subdirs(spark, archive)


@register("replay_lines", """
select event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts from events""")
def q_replay_lines(spark, sf_dir):
    """Every line arrives once, stripped; compared by what it holds."""
    dest = scratch_path(spark, "replay_dest")
    replay(spark, _archive(spark, sf_dir, "replay_archive"), dest)
    line = F.col("value")
    return spark.read.text(dest).select(
        F.get_json_object(line, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(line, "$.event_type").alias("event_type"), F.get_json_object(line, "$.ts").alias("ts"))


@register("replay_limit", """
with n as (select event_id, event_type, ts, row_number() over (order by cast(ts as date), event_id) n, count(*) over () // 2 k from events)
select event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts from n where n <= k""")
def q_replay_limit(spark, sf_dir):
    """The first half of the archive's lines, in the archive's order: whole days, then the head of the next."""
    dest = scratch_path(spark, "replay_limit_dest")
    half = events(spark, sf_dir).count() // 2
    replay(spark, _archive(spark, sf_dir, "replay_limit_archive"), dest, limit=half)
    line = F.col("value")
    return spark.read.text(dest).select(
        F.get_json_object(line, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(line, "$.event_type").alias("event_type"), F.get_json_object(line, "$.ts").alias("ts"))


def fixture_day_config() -> DayConfig:
    def transform(parsed):
        return parsed.select("event_id", "ts", "user_id", "event_type", event_date("ts").alias("event_date"))

    def staging(raw):
        return raw.select("event_id", "ts", "user_id", clean_text("event_type").alias("event_type"),
                          event_date("ts").alias("event_date"))

    def fact(stg, mark):
        fresh = stg if mark is None else stg.filter(F.col("event_date") > F.lit(mark))
        return D.first_per_key(fresh, ["event_id"], ["ts", "user_id"])

    return DayConfig(
        line_schema=STREAM_LINE_SCHEMA, keys=["event_id"], ts_col="ts", partition_col="event_date",
        transform=transform,
        contract=StructType.fromDDL("event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING"),
        staging=staging, fact=fact, fact_keys=["event_id"], fact_mark_col="event_date",
        fact_tests=lambda df: [Q.not_null("event_id"), Q.unique("event_id")],
        files_per_trigger=10,
    )


@register("reprocess_idempotent", """
select 'table' as layer, count(*) n, count(distinct event_id) n_keys from events
union all select 'fct', count(*), count(distinct event_id) from events""")
def q_reprocess_idempotent(spark, sf_dir):
    ev = events(spark, sf_dir)
    archive = scratch_path(spark, "day_archive")
    # one archive folder per UTC day, so sorted paths are in time order
    ev.select(event_date("ts").alias("day"), _line(ev).alias("value")) \
        .write.partitionBy("day").text(archive)
    # one delivery segment per day folder (however many part files it holds)
    days = list_subdirs(spark, archive)
    ws = Workspace(scratch_path(spark, "lakehouse"))
    cfg = fixture_day_config()
    run_day(spark, days, ws, cfg, run_id="run1")
    first = layer_counts(spark, ws, "event_id").collect()      # two rows
    run_day(spark, days, ws, cfg, run_id="run2")   # same day again, fresh checkpoint
    second = layer_counts(spark, ws, "event_id")
    check = reconcile_runs(spark.createDataFrame(first, second.schema), second)
    if check.filter(~F.col("ok")).limit(1).count():
        raise RuntimeError("reprocessing the day changed a layer's rows")
    return second.select("layer", "n", "n_keys")


def stream_throughput(spark, sf_dir, files_per_trigger: int = 10):
    """Stream-ingest measurement on nested 36-column lines: the events as raw
    archive lines plus repeats of every third one, delivered day by day;
    ``files_per_trigger`` day files per micro-batch (about 44,000 lines at
    sf0.1, under the reference's 50,000-row batch cap), parse, flatten, 26-hour
    watermark dedup, idempotent merge into a fresh table. Returns the run
    metrics; only the stream run itself is timed."""
    from eventmart.operators.flatten import flatten
    from eventmart.plans.catalog_models import nested_events
    from eventmart.schema import event_schema

    raw = nested_events(spark, sf_dir)
    raw = raw.unionByName(raw.filter(F.col("id").cast("long") % 3 == 0))
    landing, root = scratch_path(spark, "bench_landing"), scratch_path(spark, "bench")
    write_segments(raw.select(F.to_date("created_at").alias("_seg"), F.to_json(F.struct(*raw.columns)).alias("value")),
                   landing, "_seg")
    t = VersionedTable(spark, f"{root}/table", partition_by="event_date")
    stream = build_stream(stream_source(spark, "files", path=landing, cap=files_per_trigger), event_schema(), ["event_id"],
                          "created_at", lambda df: flatten(df, keep=[CORRUPT_COLUMN]), corrupt_col=CORRUPT_COLUMN)
    sink = merge_sink(t, ["event_id"], VersionedTable(spark, f"{root}/quarantine"), corrupt_col=CORRUPT_COLUMN)
    return run_available_now(spark, stream, sink, f"{root}/checkpoint")


# Event types the fixture's batch gate accepts -- fixed values of the driver data.
FIXTURE_KNOWN_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("batch_ingest", """
select event_id, event_type, cast(ts as date) event_date, user_id from events""")
def q_batch_ingest(spark, sf_dir):
    from eventmart.operators.flatten import flatten
    from eventmart.plans.batch import ingest_batch
    from eventmart.sources.files import read_events

    ev = events(spark, sf_dir)
    archive = scratch_path(spark, "batch_archive")
    ev.select(event_date("ts").alias("day"), _line(ev).alias("value")) \
        .write.partitionBy("day").text(archive)
    files = list_subdirs(spark, archive)
    fields = [("event_id", "event_id"), ("event_type", "event_type"), ("ts", "ts"), ("user_id", "user_id")]
    t = VersionedTable(spark, scratch_path(spark, "batch_events"), partition_by="event_date")
    for _ in range(2):   # a rerun of the same input replaces its dates
        flat = flatten(read_events(spark, files, StructType.fromDDL(STREAM_LINE_SCHEMA)),
                       fields, ts_col="ts", date_col="event_date")
        ingest_batch(spark, None, t, flat=flat, known_types=FIXTURE_KNOWN_TYPES)
    return t.read().select("event_id", "event_type", "event_date", "user_id")


@register("batch_quarantine_rerun", """
select 'table' as part, event_id from events where event_id % 10 <> 0
union all select 'quarantine', event_id from events where event_id % 10 = 0""")
def q_batch_quarantine_rerun(spark, sf_dir):
    """A batch with undated rows (every tenth) comes twice: neither its dates nor its quarantine double."""
    from eventmart.plans.batch import ingest_batch

    ev = _dated(spark, sf_dir, "event_id", "event_type")
    flat = ev.withColumn("event_date", F.when(F.col("event_id") % 10 != 0, F.col("event_date")))
    root = scratch_path(spark, "quarantine_rerun")
    t, q = VersionedTable(spark, f"{root}/table", partition_by="event_date"), VersionedTable(spark, f"{root}/quarantine")
    for _ in range(2):
        ingest_batch(spark, None, t, VersionedTable(spark, q.root), flat=flat, known_types=FIXTURE_KNOWN_TYPES, max_null_date_rate=0.5)
    return t.read().select(F.lit("table").alias("part"), "event_id").unionByName(
        VersionedTable(spark, q.root).read().select(F.lit("quarantine").alias("part"), "event_id"))


@register("hour_files", """
select event_id, event_type, user_id from events
where cast(ts as date) = (select min(cast(ts as date)) from events) and hour(ts) between 6 and 11""")
def q_hour_files(spark, sf_dir):
    """The events as an archive of one folder per day and hour; six hours of the first day are read back."""
    from eventmart.sources.files import hour_paths, read_events

    ev = events(spark, sf_dir)
    archive = scratch_path(spark, "hour_archive")
    day = ev.agg(F.min(event_date("ts"))).first()[0].isoformat()
    slot = F.concat(event_date("ts").cast("string"), F.lit("-"), F.hour("ts"))       # the hour not zero-padded
    ev.select(slot.alias("slot"), _line(ev).alias("value")).repartition("slot").write.partitionBy("slot").text(archive)
    # a path of the archive is <base>/<day>-<hour>
    paths = [f"{p.rsplit('/', 1)[0]}/slot={p.rsplit('/', 1)[1]}" for p in hour_paths(archive, day, "6-11", suffix="")]
    return read_events(spark, paths, StructType.fromDDL(STREAM_LINE_SCHEMA)).select("event_id", "event_type", "user_id")


@register("contract_checked_load", """
select event_id, user_id, event_type, cast(null as varchar) note, 0 as problems_loaded, 3 as problems_source from events""")
def q_contract_checked_load(spark, sf_dir):
    """Source files against the contract, before and after the load by name: the source lacks a
    column, has one of another type and one too many; what was loaded meets the contract."""
    from eventmart.sources.load import check_contract, contract_diff

    src = scratch_path(spark, "contract_src")
    events(spark, sf_dir).select("event_id", F.col("user_id").cast("int").alias("user_id"), "event_type", "value").write.parquet(src)
    contract = StructType.fromDDL(LOAD_CONTRACT)
    loaded = check_contract(load_by_name(spark, src, contract), contract)
    return loaded.withColumn("problems_loaded", F.lit(len(contract_diff(loaded, contract)))).withColumn(
        "problems_source", F.lit(len(contract_diff(spark.read.parquet(src), contract))))


@register("metrics_text", """
select event_type, format('{:,}', count(*)) as n_text, format('{:,}', sum(event_id)::bigint) as ids_text,
       printf('%.4f%%', 100.0 * count(*) filter (where event_id % 7 = 0) / count(*)) as rate_text
from events group by event_type""")
def q_metrics_text(spark, sf_dir):
    """Counts with thousands separators and guarded ratios as percent text, per event type."""
    from eventmart.functions.columns import guarded_ratio, pct, thousands

    per_type = events(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.count_if(F.col("event_id") % 7 == 0).alias("sevenths"))
    rated = per_type.withColumn("rate", guarded_ratio("sevenths", "n"))
    return rated.select("event_type", thousands("n").alias("n_text"), thousands("ids").alias("ids_text"), pct("rate").alias("rate_text"))
