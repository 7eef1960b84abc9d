import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from eventmart.operators.flatten import flatten
from eventmart.schema import (CORRUPT_COLUMN, EVENT_FLAT_FIELDS, event_schema, events_contract,
                              with_corrupt_column)
from eventmart.sources.files import hour_paths, parse_health, parse_hours, read_events
from eventmart.sources.load import check_contract, contract_diff, load_by_name
from eventmart.sources.messages import decode


def raw_event(i, typ, **payload):
    return {
        "id": str(1000 + i), "type": typ,
        "actor": {"id": i % 3, "login": f" user{i % 3} ", "display_login": f"user{i % 3}"},
        "repo": {"id": 10 + i % 2, "name": f"owner{i % 2}/repo{i % 2}", "url": "u"},
        "org": None, "payload": payload, "public": True,
        "created_at": f"2024-01-15T{i % 24:02d}:00:00Z", "unknown_field": 1,
    }


def write_gz(path, lines):
    with gzip.open(path, "wt") as fh:
        for line in lines:
            fh.write(line + "\n")


def test_hour_paths_and_validation():
    assert hour_paths("/raw/", "2024-01-15", "0-2") == [
        "/raw/2024-01-15-0.json.gz", "/raw/2024-01-15-1.json.gz", "/raw/2024-01-15-2.json.gz"]
    assert parse_hours("7") == [7]
    with pytest.raises(ValueError):
        parse_hours("20-24")


def test_corrupt_column_is_a_new_schema():
    s = event_schema()
    n = len(s.fields)
    extended = with_corrupt_column(s)
    assert len(s.fields) == n and len(extended.fields) == n + 1


def test_read_gzip_events_with_corrupt_lines(spark, scratch):
    d = scratch("raw")
    os.makedirs(d, exist_ok=True)
    push = raw_event(1, "PushEvent", push_id=5, size=2, distinct_size=1, head="h", before="b")
    watch = raw_event(2, "WatchEvent", action="started")
    pr = raw_event(3, "PullRequestEvent", number=7,
                   pull_request={"id": 9, "state": "closed", "merged": True,
                                 "created_at": "2024-01-14T00:00:00Z", "merged_at": "2024-01-15T01:00:00Z"})
    write_gz(f"{d}/2024-01-15-0.json.gz", [json.dumps(push), json.dumps(watch)])
    write_gz(f"{d}/2024-01-15-1.json.gz", [json.dumps(pr), '{"id": "99", "type": "PushEv', "null"])
    df = read_events(spark, hour_paths(d, "2024-01-15", "0-1"), corrupt_col=CORRUPT_COLUMN)
    health = parse_health(df).collect()[0]
    assert (health["total"], health["corrupt"]) == (5, 2)

    clean = read_events(spark, f"{d}/*.json.gz")
    flat = flatten(clean.filter(F.col("id").isNotNull()))
    check_contract(flat, events_contract())
    rows = {r["event_id"]: r for r in flat.collect()}
    assert rows["1001"]["push_id"] == 5 and rows["1002"]["push_id"] is None
    assert rows["1003"]["pr_merged"] is True and rows["1003"]["pr_number"] == 7
    assert str(rows["1001"]["event_date"]) == "2024-01-15"
    assert [c for _, c in EVENT_FLAT_FIELDS][:3] == ["event_id", "event_type", "created_at"]
    assert flat.columns[3] == "event_date" and len(flat.columns) == 36


def test_decode_malformed_message_is_all_null(spark):
    msgs = spark.createDataFrame([(b'{"a": 1}',), (b'{bad',), (None,)], "value binary")
    rows = decode(msgs, "a INT").collect()
    assert [r["a"] for r in rows] == [1, None, None]


def test_load_by_name_case_insensitive(spark, scratch):
    src = scratch("load")
    spark.createDataFrame([(1, "x", 3.0)], "EVENT_ID long, Event_Type string, extra double") \
        .write.parquet(src)
    with open(os.path.join(src, "_manifest.json"), "w") as fh:
        fh.write("{}")
    from pyspark.sql.types import StructType
    contract = StructType.fromDDL("event_id BIGINT, event_type STRING, note STRING")
    out = load_by_name(spark, src, contract)
    assert out.columns == ["event_id", "event_type", "note"]
    assert out.collect()[0].asDict() == {"event_id": 1, "event_type": "x", "note": None}
    assert contract_diff(out, contract) == []
    assert contract_diff(out.drop("note"), contract) == ["missing column note"]


def test_load_by_name_aborts_on_a_bad_file(spark, scratch):
    src = scratch("load_bad")
    spark.createDataFrame([(1, "x")], "EVENT_ID long, event_type string").write.parquet(src)
    with open(os.path.join(src, "part-99999-broken.parquet"), "wb") as fh:
        fh.write(b"this is not parquet")
    from pyspark.sql.types import StructType
    contract = StructType.fromDDL("event_id BIGINT, event_type STRING")
    with pytest.raises(Exception):
        load_by_name(spark, src, contract).collect()
