import json
import os

import pytest

from eventmart.plans.batch import IngestError, ingest_batch
from eventmart.plans.daily import day_range
from eventmart.sinks.table import VersionedTable
from tests.test_sources import raw_event, write_gz


def archive(scratch, events):
    d = scratch("raw")
    os.makedirs(d, exist_ok=True)
    write_gz(f"{d}/2024-01-15-0.json.gz", [json.dumps(e) for e in events])
    return f"{d}/*.json.gz"


def test_rerun_replaces_and_unknown_types_fail(spark, scratch):
    good = [raw_event(i, "PushEvent", push_id=i) for i in range(6)]
    glob = archive(scratch, good)
    t = VersionedTable(spark, scratch("events"), partition_by="event_date")
    r1 = ingest_batch(spark, glob, t)
    r2 = ingest_batch(spark, glob, t)           # rerun of the same day
    assert (r1.rows_read, r1.n_dates) == (6, 1)
    assert t.read().count() == 6 and r2.version == 1

    bad = archive(scratch, good + [raw_event(9, "BrandNewEvent")])
    with pytest.raises(IngestError, match="BrandNewEvent"):
        ingest_batch(spark, bad, VersionedTable(spark, scratch("e2"), partition_by="event_date"))


def test_null_dates_quarantined_or_fail(spark, scratch):
    rows = [raw_event(i, "WatchEvent") for i in range(4)]
    rows[0]["created_at"] = None
    glob = archive(scratch, rows)
    q = VersionedTable(spark, scratch("q"))
    with pytest.raises(IngestError, match="no event_date"):
        ingest_batch(spark, glob, VersionedTable(spark, scratch("e"), partition_by="event_date"), q)
    t = VersionedTable(spark, scratch("e3"), partition_by="event_date")
    r = ingest_batch(spark, glob, t, VersionedTable(spark, scratch("q2")), max_null_date_rate=0.5)
    assert (r.null_dates, t.read().count()) == (1, 3)


def test_empty_input_fails(spark, scratch):
    glob = archive(scratch, [])
    with pytest.raises(IngestError, match="no rows"):
        ingest_batch(spark, glob, VersionedTable(spark, scratch("e"), partition_by="event_date"))


def test_day_range():
    assert day_range("2024-01-30", "2024-02-01") == ["2024-01-30", "2024-01-31", "2024-02-01"]


def test_a_rerun_does_not_double_the_quarantine(spark, scratch):
    rows = [raw_event(i, "WatchEvent") for i in range(4)]
    rows[0]["created_at"] = rows[1]["created_at"] = None
    glob = archive(scratch, rows)
    t, q = VersionedTable(spark, scratch("e"), partition_by="event_date"), scratch("q")
    for _ in range(3):
        ingest_batch(spark, glob, t, VersionedTable(spark, q), max_null_date_rate=0.9)
    assert (t.read().count(), VersionedTable(spark, q).read().count()) == (2, 2)
    other = archive(scratch, rows)                                   # another input adds its own
    ingest_batch(spark, other, t, VersionedTable(spark, q), max_null_date_rate=0.9)
    assert VersionedTable(spark, q).read().count() == 4
    write_gz(f"{glob.rsplit('/', 1)[0]}/2024-01-15-0.json.gz", [json.dumps(r) for r in rows[1:]])   # the first input, mended
    ingest_batch(spark, glob, t, VersionedTable(spark, q), max_null_date_rate=0.9)
    assert VersionedTable(spark, q).read().count() == 3
