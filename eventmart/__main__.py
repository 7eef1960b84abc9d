"""Command line: ``python -m eventmart <command> ...``

    batch     --input GLOB --table PATH            explicit-schema ingest, replace touched dates
    replay    --input GLOB --dest DIR [--limit N] [--rate N] [--rows-per-file N]
                                                   raw lines -> stream landing folder
    stream    --source DIR --table PATH --checkpoint PATH [--cap FILES | --max-rows N --rows-per-file N]
              [--watermark D] [--metrics-out FILE] watermark dedup -> idempotent merge
    export    --table PATH --dest PATH             single-version export with count check
    load      --source PATH --dest PATH            truncate + load by name (flat contract)
    models    --raw PATH --warehouse PATH          star schema + data tests (error stops)
    snapshot  --raw PATH --warehouse PATH --at TS  SCD-2 snapshot of repo identity
    duplicates  --table PATH [--key K]             duplicate summary + worst offenders
    check-schema --input GLOB [--expect-rows N]    parse health and payload checks
    day       --raw DIR --day D [--hours 0-23] --lake PATH     one day end to end
    backfill  --raw DIR --start D --end D [--hours 0-23] --lake PATH [--one-pass]   days in order
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import functions as F


def _session():
    from eventmart.session import build_session
    return build_session(app="eventmart-cli")


def cmd_batch(a):
    from eventmart.plans.batch import ingest_batch
    from eventmart.sinks.table import VersionedTable
    spark = _session()
    t = VersionedTable(spark, a.table, partition_by="event_date")
    q = VersionedTable(spark, a.table.rstrip("/") + "_quarantine")
    r = ingest_batch(spark, a.input, t, q, max_null_date_rate=a.max_null_date_rate)
    print(json.dumps(r.__dict__, default=str, indent=2))


def cmd_replay(a):
    from eventmart.sinks.replay import replay
    spark = _session()
    sent = replay(spark, [a.input], a.dest, limit=a.limit, rate=a.rate, rows_per_file=a.rows_per_file)
    print(f"sent {sent:,} lines")


def cmd_stream(a):
    from eventmart.operators.flatten import flatten
    from eventmart.schema import CORRUPT_COLUMN, event_schema
    from eventmart.sinks.table import VersionedTable
    from eventmart.sources.messages import stream_source
    from eventmart.streaming.ingest import build_stream, merge_sink, metrics_report, run_available_now
    spark = _session()
    t = VersionedTable(spark, a.table, partition_by="event_date")
    q = VersionedTable(spark, a.table.rstrip("/") + "_quarantine")
    raw = stream_source(spark, a.kind, path=a.source, topic=a.topic, bootstrap=a.bootstrap, cap=a.cap,
                        max_rows=a.max_rows, rows_per_file=a.rows_per_file)
    stream = build_stream(raw, event_schema(), ["event_id"], "created_at",
                          lambda df: flatten(df, keep=[CORRUPT_COLUMN]), a.watermark,
                          corrupt_col=CORRUPT_COLUMN)
    sink = merge_sink(t, ["event_id"], q, corrupt_col=CORRUPT_COLUMN)
    m = run_available_now(spark, stream, sink,
                          a.checkpoint, table=t, watermark=a.watermark)
    metrics_report(spark, m).show(truncate=False)
    if a.metrics_out:
        with open(a.metrics_out, "w") as fh:
            fh.write(m.to_json() + "\n")


def cmd_export(a):
    from eventmart.sinks.export import export_snapshot
    from eventmart.sinks.table import VersionedTable
    spark = _session()
    print(f"exported {export_snapshot(VersionedTable(spark, a.table), a.dest):,} rows")


def cmd_load(a):
    from eventmart.schema import events_contract
    from eventmart.sources.load import full_refresh, load_by_name
    spark = _session()
    print(f"loaded {full_refresh(load_by_name(spark, a.source, events_contract()), a.dest):,} rows")


def cmd_models(a):
    from eventmart.plans.warehouse import Warehouse, build_models
    spark = _session()
    out = build_models(spark, spark.read.parquet(a.raw), Warehouse(a.warehouse))
    print(json.dumps(out, default=str, indent=2))


def cmd_snapshot(a):
    from eventmart.plans.warehouse import Warehouse, snapshot_repos
    spark = _session()
    at = dt.datetime.fromisoformat(a.at)
    print(f"snapshot version {snapshot_repos(spark, spark.read.parquet(a.raw), Warehouse(a.warehouse), at)}")


def cmd_duplicates(a):
    from eventmart.operators.aggregates import duplicate_report, duplicate_summary
    from eventmart.sinks.table import VersionedTable
    df = VersionedTable(_session(), a.table).read()
    s = duplicate_summary(df, a.key).collect()[0].asDict()
    print(json.dumps(s, indent=2))
    if s["duplicates"]:
        duplicate_report(df, [F.col(a.key)], top=10, order_cols=[a.key]).show(truncate=False)
        sys.exit(f"{a.key} is repeated on {s['duplicates']:,} rows")


def cmd_check_schema(a):
    from eventmart.operators.quality import conditional_null, expression, gate, not_null, run_tests
    from eventmart.schema import CORRUPT_COLUMN, KNOWN_EVENT_TYPES
    from eventmart.sources.files import check_health, parse_health, read_events
    spark = _session()
    ev = read_events(spark, a.input, corrupt_col=CORRUPT_COLUMN)
    flat = ev.select("*", F.col("payload.push_id").alias("push_id"),
                     F.col("payload.pull_request.merged").alias("pr_merged"))
    tests = [expression("corrupt", CORRUPT_COLUMN, F.col(CORRUPT_COLUMN).isNotNull()),
             not_null("id"), not_null("type"), not_null("created_at"),
             expression("unknown_type", "type", ~F.col("type").isin(sorted(KNOWN_EVENT_TYPES))),
             *conditional_null("push_id", F.col("type") == "PushEvent")]
    check_health(parse_health(ev), a.expect_rows)
    results = run_tests(flat, tests)
    results.show(truncate=False)
    gate(results)
    merged = flat.filter(F.col("pr_merged")).limit(1).count()
    if not merged:
        sys.exit("the nested pull-request fields came out empty on every row")
    print("every check of the declared schema passed")


def _day_paths(raw: str, hours: str):
    """Paths of a day's hours; the replay fails on those that are absent."""
    from eventmart.sources.files import hour_paths
    return lambda day: hour_paths(raw, day, hours)


def cmd_day(a):
    from eventmart.plans.daily import Workspace, event_day_config, run_day
    spark = _session()
    r = run_day(spark, _day_paths(a.raw, a.hours)(a.day), Workspace(a.lake), event_day_config(),
                run_id=f"day-{a.day}-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}")
    print(json.dumps({"sent": r.sent, "stream": r.stream.as_row(), "exported": r.exported,
                      "loaded": r.loaded, "warnings": r.warnings}, default=str, indent=2))


def cmd_backfill(a):
    from eventmart.plans.daily import Workspace, backfill, day_range, event_day_config
    spark = _session()
    results = backfill(spark, day_range(a.start, a.end), _day_paths(a.raw, a.hours),
                       Workspace(a.lake), event_day_config(), one_pass=a.one_pass)
    print(json.dumps([{"sent": r.sent, "input_rows": r.stream.input_rows} for r in results], indent=2))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="eventmart", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("batch"); s.add_argument("--input", required=True); s.add_argument("--table", required=True)
    s.add_argument("--max-null-date-rate", type=float, default=0.0); s.set_defaults(fn=cmd_batch)
    s = sub.add_parser("replay"); s.add_argument("--input", required=True); s.add_argument("--dest", required=True)
    s.add_argument("--limit", type=int, default=0); s.add_argument("--rate", type=float, default=0.0)
    s.add_argument("--rows-per-file", type=int, default=0)
    s.set_defaults(fn=cmd_replay)
    s = sub.add_parser("stream"); s.add_argument("--source"); s.add_argument("--table", required=True)
    s.add_argument("--checkpoint", required=True); s.add_argument("--cap", type=int, default=1)
    s.add_argument("--kind", default="files", choices=["files", "kafka"]); s.add_argument("--topic")
    s.add_argument("--bootstrap"); s.add_argument("--watermark", default="26 hours")
    s.add_argument("--max-rows", type=int); s.add_argument("--rows-per-file", type=int)
    s.add_argument("--metrics-out"); s.set_defaults(fn=cmd_stream)
    s = sub.add_parser("export"); s.add_argument("--table", required=True); s.add_argument("--dest", required=True)
    s.set_defaults(fn=cmd_export)
    s = sub.add_parser("load"); s.add_argument("--source", required=True); s.add_argument("--dest", required=True)
    s.set_defaults(fn=cmd_load)
    s = sub.add_parser("models"); s.add_argument("--raw", required=True); s.add_argument("--warehouse", required=True)
    s.set_defaults(fn=cmd_models)
    s = sub.add_parser("snapshot"); s.add_argument("--raw", required=True)
    s.add_argument("--warehouse", required=True); s.add_argument("--at", required=True); s.set_defaults(fn=cmd_snapshot)
    s = sub.add_parser("duplicates"); s.add_argument("--table", required=True); s.add_argument("--key", default="event_id")
    s.set_defaults(fn=cmd_duplicates)
    s = sub.add_parser("check-schema"); s.add_argument("--input", required=True)
    s.add_argument("--expect-rows", type=int); s.set_defaults(fn=cmd_check_schema)
    s = sub.add_parser("day"); s.add_argument("--raw", required=True); s.add_argument("--day", required=True)
    s.add_argument("--hours", default="0-23"); s.add_argument("--lake", required=True); s.set_defaults(fn=cmd_day)
    s = sub.add_parser("backfill"); s.add_argument("--raw", required=True); s.add_argument("--start", required=True)
    s.add_argument("--end", required=True); s.add_argument("--hours", default="0-23")
    s.add_argument("--lake", required=True); s.add_argument("--one-pass", action="store_true")
    s.set_defaults(fn=cmd_backfill)
    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
