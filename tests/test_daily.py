"""One day and a backfill of the event archive end to end (H2 H3)."""

import json
import os

from eventmart.plans.daily import Workspace, backfill, event_day_config, run_day
from eventmart.plans.warehouse import Warehouse
from eventmart.sinks.table import VersionedTable
from eventmart.sources.files import hour_paths
from tests.test_sources import raw_event, write_gz


def day_files(raw_dir, day, n, start):
    for h in range(2):
        evs = []
        for i in range(start + h * n, start + (h + 1) * n):
            e = raw_event(i, "PushEvent" if i % 2 else "WatchEvent", push_id=i if i % 2 else None)
            e["created_at"] = f"{day}T{h:02d}:{i % 60:02d}:00Z"
            evs.append(json.dumps(e))
        write_gz(f"{raw_dir}/{day}-{h}.json.gz", evs)


def test_backfill_two_days_then_rerun_converges(spark, scratch):
    raw = scratch("archive")
    os.makedirs(raw, exist_ok=True)
    day_files(raw, "2024-01-15", 5, 0)
    day_files(raw, "2024-01-16", 5, 100)
    ws = Workspace(scratch("lake"))
    cfg = event_day_config()

    def paths(day):
        return [p for p in hour_paths(raw, day, "0-23") if os.path.exists(p)]
    results = backfill(spark, ["2024-01-16", "2024-01-15"], paths, ws, cfg)   # runs in date order
    assert [r.sent for r in results] == [10, 10]
    wh = Warehouse(f"{ws.root}/warehouse")
    assert VersionedTable(spark, ws.events).read().count() == 20
    assert wh.table(spark, "fct_events").read().count() == 20
    dims = {r["repo_id"]: r for r in wh.table(spark, "dim_repos").read().collect()}
    assert str(dims[10]["last_seen_date"]) == "2024-01-16"

    again = run_day(spark, paths("2024-01-15"), ws, cfg, run_id="rerun-2024-01-15")
    assert again.stream.input_rows == 10
    assert VersionedTable(spark, ws.events).read().count() == 20
    assert wh.table(spark, "fct_events").read().count() == 20


def test_cli_day(spark, scratch, capsys):
    from eventmart.__main__ import main
    raw = scratch("archive")
    os.makedirs(raw, exist_ok=True)
    day_files(raw, "2024-01-15", 3, 0)
    main(["day", "--raw", raw, "--day", "2024-01-15", "--hours", "0-1", "--lake", scratch("lake")])
    out = json.loads(capsys.readouterr().out)
    assert out["sent"] == 6 and out["stream"]["table_rows_after_run"] == 6


def test_a_backfill_lands_days_together_and_gives_the_tables_of_a_serial_one(spark, scratch, monkeypatch):
    import time

    from eventmart.operators.fingerprint import differences, fingerprint
    from eventmart.plans import daily
    from eventmart.plans.warehouse import ModelStates

    raw = scratch("archive")
    os.makedirs(raw, exist_ok=True)
    days = ["2024-01-15", "2024-01-16", "2024-01-17"]
    for i, day in enumerate(days):
        day_files(raw, day, 6, 100 * i)
    spans, land = [], daily.land_day

    def timed(*args):
        start = time.monotonic()
        time.sleep(0.5)
        n = land(*args)
        spans.append((start, time.monotonic()))
        return n
    monkeypatch.setattr(daily, "land_day", timed)
    together, serial = Workspace(scratch("together")), Workspace(scratch("serial"))
    cfg = event_day_config()

    def paths(day):
        return hour_paths(raw, day, "0-1")
    assert [r.sent for r in backfill(spark, days, paths, together, cfg)] == [12] * 3
    assert max(s for s, _ in spans) < min(e for _, e in spans)          # all three at once
    results = [run_day(spark, paths(d), serial, cfg, run_id=d) for d in days]
    assert [r.exported for r in results] == [r.loaded for r in results] == [12] * 3      # of the day's date only

    def tables(ws):
        wh = Warehouse(f"{ws.root}/warehouse")
        states = ModelStates(spark, wh)
        return {"events": VersionedTable(spark, ws.events).read(), "raw": spark.read.parquet(ws.raw),
                **{n: wh.mart(spark, n).read() for n in ("fct_events", "dim_repos", "dim_actors")}, **states.models()}
    a, b = tables(together), tables(serial)
    for name in a:
        assert a[name].count() > 0 and differences(fingerprint(a[name]), fingerprint(b[name])).count() == 0, name


def test_a_day_exports_and_loads_its_own_dates_and_states_follow(spark, scratch):
    from eventmart.plans.models import int_daily_repo_activity, stg_events
    from eventmart.plans.warehouse import ModelStates

    raw = scratch("archive")
    os.makedirs(raw, exist_ok=True)
    day_files(raw, "2024-01-15", 5, 0)
    day_files(raw, "2024-01-16", 5, 100)
    ws, cfg = Workspace(scratch("lake")), event_day_config()
    run_day(spark, hour_paths(raw, "2024-01-15", "0-1"), ws, cfg, run_id="a")
    before = set(spark.read.parquet(ws.export).inputFiles()) | set(spark.read.parquet(ws.raw).inputFiles())
    run_day(spark, hour_paths(raw, "2024-01-16", "0-1"), ws, cfg, run_id="b")
    now = set(spark.read.parquet(ws.export).inputFiles()) | set(spark.read.parquet(ws.raw).inputFiles())
    assert before < now                                                 # the first day's files were not written again
    states = ModelStates(spark, Warehouse(f"{ws.root}/warehouse"))
    touched = [c["replaced_parts"] for c in states.activity.table.commits()]
    assert touched == [[], ["2024-01-16"]]
    full = int_daily_repo_activity(stg_events(VersionedTable(spark, ws.events).read()))
    assert sorted(map(repr, states.models()["int_daily_repo_activity"].collect())) == sorted(map(repr, full.collect()))
    # a late row of the first day comes with the second: a rerun takes in that date as well
    day_files(raw, "2024-01-15", 7, 200)
    run_day(spark, hour_paths(raw, "2024-01-15", "0-1"), ws, cfg, run_id="c")
    full = int_daily_repo_activity(stg_events(VersionedTable(spark, ws.events).read()))
    states = ModelStates(spark, Warehouse(f"{ws.root}/warehouse"))
    assert sorted(map(repr, states.models()["int_daily_repo_activity"].collect())) == sorted(map(repr, full.collect()))
    assert spark.read.parquet(ws.raw).count() == VersionedTable(spark, ws.events).read().count() == 34
