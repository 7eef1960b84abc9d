import json

import pytest
from pyspark.sql import functions as F

from eventmart.sinks.replay import clean_lines, write_segments
from eventmart.sinks.table import VersionedTable
from eventmart.sources.messages import stream_source
from eventmart.streaming.ingest import (build_stream, merge_sink, metrics_frame, metrics_report,
                                       run_available_now)

SCHEMA = "event_id BIGINT, ts TIMESTAMP, event_type STRING"


def line(i, ts, t="click"):
    return json.dumps({"event_id": i, "ts": ts, "event_type": t})


def landing_files(spark, scratch, segments):
    """segments: list of lists of JSON lines, one delivery file each, in order."""
    rows = [(n, v) for n, seg in enumerate(segments) for v in seg]
    dest = scratch("landing")
    write_segments(spark.createDataFrame(rows, "_seg int, value string"), dest, "_seg")
    return dest


def output(df):
    return df.withColumn("event_date", F.to_date("ts"))


def ingest(spark, landing, root, ckpt, delay="26 hours", quarantine=None, fault=None):
    t = VersionedTable(spark, root, partition_by="event_date")
    t.fault = fault
    raw = stream_source(spark, "files", path=landing, cap=1)
    stream = build_stream(raw, SCHEMA, ["event_id"], "ts", delay=delay)
    quarantine = quarantine or VersionedTable(spark, f"{root}-quarantine")
    m = run_available_now(spark, stream, merge_sink(t, ["event_id"], quarantine, output=output), ckpt, table=t)
    assert m.input_rows == m.inserted + m.matched + m.quarantined + m.dropped_by_watermark + m.deduplicated
    return t, m


def test_dedup_restart_after_commit_and_fresh_checkpoint_rerun(spark, scratch):
    segs = [[line(1, "2024-01-01T00:00:00"), line(1, "2024-01-01T00:00:00"), line(2, "2024-01-01T01:00:00")],
            [line(3, "2024-01-02T00:00:00"), line(2, "2024-01-01T01:00:00")],
            [line(4, "2024-01-03T00:00:00")]]
    landing = landing_files(spark, scratch, segs)
    root, ckpt = scratch("tbl"), scratch("ckpt")
    fired = []

    def crash_after_commit(version, stage):
        # the table committed the batch, Spark's checkpoint has not: replay
        if version == 2 and stage == "commit" and not fired:
            fired.append(version)
            raise RuntimeError("crash after commit")
    with pytest.raises(Exception):
        ingest(spark, landing, root, ckpt, fault=crash_after_commit)
    t, m = ingest(spark, landing, root, ckpt)
    assert sorted(r["event_id"] for r in t.read().collect()) == [1, 2, 3, 4]
    qid = t.commits()[-1]["query_id"]
    batch_ids = [c["batch_id"] for c in t.commits() if c["query_id"] == qid]
    assert len(batch_ids) == len(set(batch_ids)) >= 3
    # same day again with a fresh checkpoint converges (insert-only merge)
    t2, m2 = ingest(spark, landing, root, scratch("ckpt2"))
    assert t2.read().count() == 4 and m2.input_rows > 0
    assert metrics_frame(spark, m2).count() == 1
    report = metrics_report(spark, m2).collect()[0]
    assert report["late_rate"].endswith("%")


def test_a_micro_batch_writes_one_file_per_small_partition(spark, scratch):
    """The stream's own session plans without AQE: there, each task writes each date."""
    segs = [[line(i + 100 * s, f"2024-01-0{1 + i % 2}T0{i % 10}:00:00") for i in range(60)] for s in range(2)]
    t, m = ingest(spark, landing_files(spark, scratch, segs), scratch("tbl"), scratch("ckpt"), delay="3 days")
    assert (m.inserted, t.read().count()) == (120, 120)
    files = [f for c in t.commits() if c["num_output_rows"]
             for f in spark.read.parquet(t._attempt_path(c["version"], c["attempt"])).inputFiles()]
    assert len(files) == 2 * m.batches


def test_late_rows_dropped_after_watermark_lag(spark, scratch):
    # a@00:00 | c@05:00 | d@05:01 | late z@00:02 + y@04:55, 10-minute mark
    segs = [[line(1, "2024-01-01T00:00:00")], [line(2, "2024-01-01T05:00:00")],
            [line(3, "2024-01-01T05:01:00")],
            [line(4, "2024-01-01T00:02:00"), line(5, "2024-01-01T04:55:00")]]
    landing = landing_files(spark, scratch, segs)
    t, m = ingest(spark, landing, scratch("tbl"), scratch("ckpt"), delay="10 minutes")
    assert (m.input_rows, m.dropped_by_watermark) == (5, 1)
    assert sorted(r["event_id"] for r in t.read().collect()) == [1, 2, 3, 5]


def test_null_and_malformed_keys_go_to_quarantine(spark, scratch):
    bad_line = '{"event_id": 7, "ts": "2024-01-01T00:0'
    segs = [[line(1, "2024-01-01T00:00:00"), line(1, "2024-01-01T00:00:00"),
             '{"event_id": null, "ts": "2024-01-01T00:00:00"}',
             '{"event_id": null, "ts": "2024-01-01T00:05:00"}', bad_line]]
    landing = landing_files(spark, scratch, segs)
    q = VersionedTable(spark, scratch("quarantine"))
    t = VersionedTable(spark, scratch("tbl"), partition_by="event_date")
    raw = stream_source(spark, "files", path=landing, cap=1)
    stream = build_stream(raw, SCHEMA, ["event_id"], "ts", transform=output, corrupt_col="_corrupt_record")
    run_available_now(spark, stream, merge_sink(t, ["event_id"], q, output=None,
                                                corrupt_col="_corrupt_record"), scratch("ckpt"), table=t)
    assert [r["event_id"] for r in t.read().collect()] == [1]
    assert "_corrupt_record" not in t.read().columns
    quarantined = q.read().collect()
    assert len(quarantined) == 3          # both null keys kept (no key dedup) + the bad line
    assert [r["_corrupt_record"] for r in quarantined if r["_corrupt_record"]] == [bad_line]


def test_clean_lines_strips_all_whitespace(spark):
    df = spark.createDataFrame([(" a ",), ("\t\r\n",), ("",), ("b\t",)], "value string")
    assert sorted(r[0] for r in clean_lines(df).collect()) == ["a", "b"]
