"""Nothing is lost in silence: absent inputs, mixed files, typed partitions,
races and torn commits, bad rows, repeated keys."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from eventmart.operators import quality as Q
from eventmart.operators.asof import as_of, history
from eventmart.plans.daily import Workspace, backfill, event_day_config, run_day
from eventmart.plans.models import fct_events
from eventmart.sinks.replay import replay, write_segments
from eventmart.sinks.table import CommitConflict, VersionedTable, create_text
from eventmart.sources.files import check_health, expand_paths, hour_paths, parse_hours
from eventmart.sources.load import load_by_name
from eventmart.sources.messages import stream_source
from eventmart.streaming.ingest import UnaccountedRows, run_available_now
from tests.test_daily import day_files
from tests.test_streaming import ingest, landing_files, line


def test_an_absent_hour_stops_the_day(spark, scratch):
    raw = scratch("archive")
    os.makedirs(raw, exist_ok=True)
    day_files(raw, "2024-01-15", 2, 0)      # hours 0 and 1
    with pytest.raises(FileNotFoundError, match="2 of 4"):
        run_day(spark, hour_paths(raw, "2024-01-15", "0-3"), Workspace(scratch("lake")), event_day_config(), run_id="r")
    assert len(expand_paths(spark, [f"{raw}/2024-01-15-*.json.gz"])) == 2


@pytest.mark.parametrize("text", ["", "x", "3-1", "24", "0-24", "-1", "1-2-3"])
def test_hours_out_of_range(text):
    with pytest.raises(ValueError):
        parse_hours(text)


def test_one_pass_backfill_gives_the_same_tables(spark, scratch):
    raw = scratch("archive")
    os.makedirs(raw, exist_ok=True)
    day_files(raw, "2024-01-15", 4, 0)
    day_files(raw, "2024-01-16", 4, 100)
    ws = Workspace(scratch("lake"))
    out = backfill(spark, ["2024-01-16", "2024-01-15"], lambda d: hour_paths(raw, d, "0-1"), ws, event_day_config(), one_pass=True)
    assert [r.sent for r in out] == [16] and VersionedTable(spark, ws.events).read().count() == 16


def test_files_of_different_schemas(spark, scratch):
    src = scratch("mixed")
    spark.createDataFrame([(1,)], "id long").write.parquet(src)
    spark.createDataFrame([(2, "kept")], "id long, NOTE string").write.mode("append").parquet(src)
    from pyspark.sql.types import StructType
    contract = StructType.fromDDL("id long, note string")
    assert sorted(tuple(r) for r in load_by_name(spark, src, contract).collect()) == [(1, None), (2, "kept")]
    spark.createDataFrame([("3",)], "id string").write.mode("append").parquet(src)
    with pytest.raises(Exception, match="(?i)merge"):
        load_by_name(spark, src, contract).count()


@pytest.mark.parametrize("kind,values", [
    ("boolean", [True, False, None]), ("double", [0.5, 1e20, -0.0]), ("string", ["", "a b", "x/y=%", None]),
    ("timestamp_ntz", [dt.datetime(2024, 1, 1, 0, 0, 0, 250000), dt.datetime(2024, 1, 1)]), ("int", [1, -1]),
    ("date", [dt.date(2024, 1, 1), None]), ("decimal(9,3)", [__import__("decimal").Decimal("1.500")])])
def test_replacing_a_partition_twice_equals_once(spark, scratch, kind, values):
    t = VersionedTable(spark, scratch("typed"), partition_by="p")
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, p {kind}")
    t.append(rows)
    for _ in range(2):
        t.replace_partitions(rows)
    assert sorted(r["id"] for r in t.read().collect()) == list(range(len(values)))


def test_a_lost_race_changes_nothing(spark, scratch):
    root = scratch("race")
    a, b = VersionedTable(spark, root), VersionedTable(spark, root)
    a.append(spark.createDataFrame([(1,)], "id long"))
    b.commits()

    def meanwhile(version, stage):
        if stage == "data":
            b.fault = None
            VersionedTable(spark, root).append(spark.createDataFrame([(2,), (3,)], "id long"))
    b.fault = meanwhile
    with pytest.raises(CommitConflict):
        b.append(spark.createDataFrame([(9,)], "id long"))
    assert sorted(r["id"] for r in VersionedTable(spark, root).read().collect()) == [1, 2, 3]


def test_a_torn_commit_is_not_a_commit(spark, scratch):
    root = scratch("torn")
    t = VersionedTable(spark, root)
    t.append(spark.createDataFrame([(1,)], "id long"))
    with open(f"{root}/commits/{1:020d}.json.abc.tmp", "w"):
        pass                                    # what a crash while writing leaves
    assert VersionedTable(spark, root).read().count() == 1
    assert t.append(spark.createDataFrame([(2,)], "id long")) == 1
    with pytest.raises(CommitConflict):
        create_text(spark, f"{root}/commits/{0:020d}.json", "{}")
    assert VersionedTable(spark, root).read().count() == 2


def test_a_key_on_two_dates_is_inserted_once(spark, scratch):
    segs = [[line(1, "2024-01-01T00:00:00")], [line(2, "2024-03-01T00:00:00")],
            [line(3, "2024-03-02T00:00:00")], [line(1, "2024-03-05T00:00:00")]]   # key 1 has left the state by then
    t, m = ingest(spark, landing_files(spark, scratch, segs), scratch("t"), scratch("c"), delay="1 hour")
    assert sorted(r["event_id"] for r in t.read().collect()) == [1, 2, 3]
    assert (m.inserted, m.matched) == (3, 1)


def test_every_input_row_is_accounted_for(spark, scratch):
    segs = [[line(1, "2024-01-01T00:00:00"), line(1, "2024-01-01T00:00:00"), '{"event_id": null, "ts": "2024-01-01T00:00:00"}'],
            [line(2, "2024-01-09T00:00:00")], [line(4, "2024-01-09T01:00:00")], [line(3, "2024-01-01T00:00:00")]]
    _, m = ingest(spark, landing_files(spark, scratch, segs), scratch("t"), scratch("c"), delay="1 hour")
    assert (m.input_rows, m.inserted, m.quarantined, m.deduplicated, m.dropped_by_watermark) == (6, 3, 1, 1, 1)
    assert json.loads(m.to_json())["late_event_rate"] == 1 / 6


def test_more_rows_than_the_source_gave_is_an_error(spark, scratch):
    from eventmart.streaming.ingest import build_stream, merge_sink
    landing = landing_files(spark, scratch, [[line(1, "2024-01-01T00:00:00")]])
    sink = merge_sink(VersionedTable(spark, scratch("t")), ["event_id"], VersionedTable(spark, scratch("q")))
    sink.staged = 5
    stream = build_stream(stream_source(spark, "files", path=landing), "event_id BIGINT, ts TIMESTAMP, event_type STRING", ["event_id"], "ts")
    with pytest.raises(UnaccountedRows):
        run_available_now(spark, stream, sink, scratch("c"))


def test_replay_order_limit_rate_and_file_size(spark, scratch):
    src, dest = scratch("src"), scratch("dest")
    os.makedirs(src, exist_ok=True)
    for n in range(3):
        with open(f"{src}/{n}.txt", "w") as fh:
            fh.write("".join(f" {n}-{k} \n\n" for k in range(10)))
    paths = [f"{src}/{n}.txt" for n in (2, 0, 1)]
    assert replay(spark, paths, dest, limit=14, rows_per_file=4) == 14
    files = sorted(f for f in os.listdir(dest) if f.endswith(".txt"))
    stamps = [os.path.getmtime(f"{dest}/{f}") for f in files]
    assert stamps == sorted(set(stamps))
    seen = [open(f"{dest}/{f}").read().split() for f in files]
    assert max(map(len, seen)) <= 4
    order = [x.split("-")[0] for part in seen for x in part]
    assert order == ["2"] * 10 + ["0"] * 4
    began = dt.datetime.now()
    assert replay(spark, paths, scratch("slow"), rate=20) == 30
    assert (dt.datetime.now() - began).total_seconds() >= 1.4
    with pytest.raises(ValueError):
        stream_source(spark, "files", path=dest, max_rows=3, rows_per_file=4)


def test_null_segment_and_no_rows(spark, scratch):
    df = spark.createDataFrame([(None, "a"), (dt.date(2024, 1, 1), "b")], "seg date, value string")
    assert [n for _, n in write_segments(df, scratch("d"), "seg")] == [1, 1]
    assert write_segments(df.filter("value = 'c'"), scratch("e"), "seg") == []


def test_health_counts_every_line(spark):
    good = spark.createDataFrame([(3, 0)], "total long, corrupt long")
    check_health(good, 3)
    with pytest.raises(ValueError, match="expected"):
        check_health(good, 4)
    with pytest.raises(ValueError, match="parse"):
        check_health(spark.createDataFrame([(3, 1)], "total long, corrupt long"))


def test_hot_key_is_counted_before_the_reference_check(spark):
    child = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    parent = spark.range(1, 500).select(F.col("id").alias("p"))
    out = Q.relationship_failures(child, "k", parent, "p")
    assert out.first()["failures"] == sum(1 for i in range(2000) if (7 if i % 2 == 0 else i) not in range(1, 500))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.rindex("partial_count(1)")   # the counts are below the join


def test_rows_that_differ_only_in_which_column_is_null(spark):
    rows = [("1", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), "x", None), ("1", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), None, "x")]
    schema = "event_id string, created_at timestamp, event_date date, action string, ref string"
    picks = {tuple(fct_events(spark.createDataFrame(order, schema)).first()) for order in (rows, rows[::-1])}
    assert len(picks) == 1


def test_as_of_versioned_rows(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "a", 1), (4, None, 2)], "id long, p string, version int")
    gone = spark.createDataFrame([(1, "a"), (2, None)], "version int, part string")
    see = lambda n: sorted(r["id"] for r in as_of(rows, n, part_col="p", replaced=gone).collect())
    assert (see(0), see(1), see(2)) == ([1, 2], [2, 3], [3, 4])
    assert [tuple(r) for r in history(rows).collect()] == [(0, 2), (1, 1), (2, 1)]
