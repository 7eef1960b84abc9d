"""The key index: what a merge may skip, and how little it reads for that."""

import datetime as dt
import glob
import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructType

from eventmart.sinks.key_index import PART, KeyIndex, _any_of, _is_set, _probes, _ranges
from eventmart.sinks.table import VersionedTable, list_subdirs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = StructType().add("id", StringType()).add("d", DateType()).add("v", IntegerType())
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]


def frame(spark, ids, day=0):
    return spark.createDataFrame([(str(i), DAYS[day], int(i)) for i in ids], SCHEMA)


def test_filter_bits_are_those_that_the_bitmap_sets(spark):
    keys = spark.range(300).withColumn("h", F.xxhash64("id"))
    bits = keys.select(F.explode(_probes(F.col("h"))).alias("p")).agg(F.bitmap_construct_agg("p").alias("bits"))
    all_set = keys.select(F.explode(_probes(F.col("h"))).alias("p")).join(bits).filter(~_is_set("bits", F.col("p"))).count()
    other = spark.range(10_000, 30_000).select(_probes(F.xxhash64("id")).alias("p")).join(bits)
    passed = other.filter(_is_set("bits", F.col("p")[0]) & _is_set("bits", F.col("p")[1]) & _is_set("bits", F.col("p")[2])
                          & _is_set("bits", F.col("p")[3])).count()
    assert all_set == 0 and passed < 20       # 300 keys in 32,768 bits let almost nothing else pass


def test_ranges_and_balanced_disjunctions(spark):
    assert _ranges([]) == [] and _ranges([5, 1, 2, 3, 9]) == [(1, 3), (5, 5), (9, 9)]
    hit = spark.range(100).filter(_any_of([F.col("id") == i for i in range(0, 100, 7)]))
    assert [r.id for r in hit.orderBy("id").collect()] == list(range(0, 100, 7))


@pytest.mark.parametrize("max_runs,bucket_rows", [(2, 4), (8, 2048)])
def test_lookup_equals_a_join_over_many_runs(spark, scratch, max_runs, bucket_rows):
    index = KeyIndex(spark, scratch("keys"), ["id"], SCHEMA, "d", bucket_rows, max_runs)
    runs, held = [], {}
    for step in range(6):
        ids = range(step * 10, step * 10 + 25)            # 15 of 25 come again under another date
        new = frame(spark, ids, step)
        found = index.matched(new, runs)
        got = set() if found is None else {(r["id"], r[PART]) for r in found.collect()}
        assert got == {(str(i), d) for i in ids for d in held.get(str(i), [])}
        runs = index.add(new, 25, runs)
        for i in ids:
            held.setdefault(str(i), []).append(DAYS[step])
        assert len(runs) <= max_runs and sum(r["rows"] for r in runs) == 25 * (step + 1)
    assert index.matched(frame(spark, range(5000, 5004)), runs) is None or index.matched(frame(spark, range(5000, 5004)), runs).count() == 0


def test_types_of_the_batch_need_not_be_the_tables(spark, scratch):
    index = KeyIndex(spark, scratch("keys"), ["id"], StructType().add("id", LongType()))
    runs = index.add(spark.createDataFrame([(1,), (2,)], "id long"), 2, [])
    assert [r.id for r in index.matched(spark.createDataFrame([(2,), (3,)], "id int"), runs).collect()] == [2]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_of_a_large_batch_are_not_sent_whole_to_every_task(spark, scratch):
    """200,000 keys in files of under 2 MB, which Spark would broadcast."""
    path = scratch("batch")
    spark.range(200_000).write.parquet(path)
    batch = spark.read.parquet(path)
    index = KeyIndex(spark, scratch("keys"), ["id"], batch.schema)
    old = spark.range(199_000, 230_000)
    runs = index.add(old, 31_000, index.add(spark.range(-500, 0), 500, []))
    found = index.matched(batch, runs)
    assert "BroadcastHashJoin" not in _plan(found) and "SortMergeJoin" in _plan(found)
    assert sorted(r.id for r in found.collect()) == list(range(199_000, 200_000))
    hits = index._hit_buckets(index._hashed(batch), runs, 200_000)
    assert "BroadcastHashJoin" not in _plan(hits) and "SortMergeJoin" in _plan(hits)
    few = batch.filter("id >= 199990")
    hits_of_few = index._hit_buckets(index._hashed(few), runs, 10)
    assert "BroadcastHashJoin" in _plan(hits_of_few)
    assert {tuple(r) for r in hits_of_few.collect()} <= {tuple(r) for r in hits.collect()}
    assert sorted(r.id for r in index.matched(few, runs).collect()) == list(range(199_990, 200_000))


@pytest.mark.parametrize("max_ranges", [256, 0])        # buckets by name, runs whole
def test_a_large_batch_is_sorted_once_for_all_runs(spark, scratch, monkeypatch, max_ranges):
    monkeypatch.setattr("eventmart.sinks.key_index.BROADCAST_ROWS", 0)
    monkeypatch.setattr("eventmart.sinks.key_index.MAX_RANGES", max_ranges)
    index = KeyIndex(spark, scratch("keys"), ["id"], SCHEMA, "d", bucket_rows=4)
    runs = []
    for step in range(5):
        n = 10 * (step + 1)                                # runs of 4, 8 and 16 buckets
        runs = index.add(frame(spark, range(100 * step, 100 * step + n), step), n, runs)
    found = index.matched(frame(spark, [*range(95, 120), *range(205, 210), *range(405, 500)]), runs)
    assert _plan(found).count("SortMergeJoin") == 1 and "Union" not in _plan(found)
    want = {**dict.fromkeys(range(100, 120), 1), **dict.fromkeys(range(205, 210), 2), **dict.fromkeys(range(405, 450), 4)}
    assert sorted((int(r["id"]), r[PART]) for r in found.collect()) == [(i, DAYS[d]) for i, d in want.items()]


def test_keys_that_a_large_batch_finds_are_not_sent_whole_to_every_task(spark, scratch, monkeypatch):
    batch = frame(spark, range(50), 1)
    index = KeyIndex(spark, scratch("keys"), ["id"], SCHEMA, "d")
    runs = index.add(frame(spark, range(40)), 40, [])

    def new_rows():
        return batch.join(index.matched(batch, runs).select("id"), ["id"], "left_anti")
    assert "BroadcastHashJoin" in _plan(new_rows())
    monkeypatch.setattr("eventmart.sinks.key_index.BROADCAST_ROWS", 49)
    new = new_rows()
    assert "BroadcastHashJoin" not in _plan(new) and _plan(new).count("SortMergeJoin") == 2
    assert sorted(int(r["id"]) for r in new.collect()) == list(range(40, 50))


def test_a_key_that_comes_again_under_another_date_is_matched_by_dealt_out_joins_too(spark, scratch, monkeypatch):
    monkeypatch.setattr("eventmart.sinks.key_index.BROADCAST_ROWS", 0)
    t = VersionedTable(spark, scratch("t"), partition_by="d")
    t.merge_insert(frame(spark, range(20)), ["id"])
    t.merge_insert(frame(spark, range(15, 30), 39), ["id"])      # 15 to 19 are there
    t.merge_insert(frame(spark, range(25, 32), 5), ["id"])       # 25 to 29 are there
    want = {**{str(i): DAYS[0] for i in range(20)}, **{str(i): DAYS[39] for i in range(20, 30)}, "30": DAYS[5], "31": DAYS[5]}
    rows = t.read().collect()
    assert len(rows) == 32 and {r["id"]: r["d"] for r in rows} == want


def test_filters_are_built_by_tasks_of_few_keys_each(spark, scratch, monkeypatch):
    monkeypatch.setattr("eventmart.sinks.key_index.FILTER_ROWS", 1000)
    index = KeyIndex(spark, scratch("keys"), ["id"], StructType().add("id", LongType()), bucket_rows=64)
    runs = index.add(spark.range(10_000), 10_000, [])
    files = glob.glob(index._path(runs[0], "filter").removeprefix("file:") + "/part-*")
    filters = index._filters(runs)
    assert 5 <= len(files) <= 10 and filters.count() == filters.select("_bucket").distinct().count() == runs[0]["buckets"] == 256
    assert index.matched(spark.range(9_990, 10_010), runs).count() == 10


def test_merges_and_upserts_through_the_index(spark, scratch):
    t = VersionedTable(spark, scratch("t"), partition_by="d")
    t.append(frame(spark, range(5)))                        # not indexed yet
    t.merge_insert(frame(spark, range(3, 8), 1), ["id"])     # 3 and 4 are there
    t.upsert(frame(spark, [4, 6, 20], 2), ["id"])            # 4 and 6 move to another date
    t.merge_insert(frame(spark, [4, 6, 20, 21], 3), ["id"])
    got = {r["id"]: r["d"] for r in t.read().collect()}
    assert got == {**{str(i): DAYS[0] for i in (0, 1, 2, 3)}, "5": DAYS[1], "7": DAYS[1], **{str(i): DAYS[2] for i in (4, 6, 20)}, "21": DAYS[3]}
    assert sorted(t.commits()[2]["replaced_parts"]) == ["2024-01-01", "2024-01-02"]
    t.delete(F.col("v") < 2)                                 # the index may not hold what was deleted
    t.merge_insert(frame(spark, [0, 2], 4), ["id"])
    assert {r["id"]: r["d"] for r in t.read().filter("v < 3").collect()} == {"0": DAYS[4], "2": DAYS[0]}
    t.replace_partitions(frame(spark, [77], 2))
    t.merge_insert(frame(spark, [4, 77], 5), ["id"])
    assert {r["id"]: r["d"] for r in t.read().filter("v in (4, 77)").collect()} == {"4": DAYS[5], "77": DAYS[2]}


def test_null_partitions_and_repeated_keys_of_a_batch(spark, scratch):
    t = VersionedTable(spark, scratch("t"), partition_by="d")
    rows = spark.createDataFrame([("1", None, 1), ("2", DAYS[0], 2)], SCHEMA)
    t.merge_insert(rows, ["id"])
    t.merge_insert(rows.unionByName(rows).unionByName(frame(spark, [3, 3])), ["id"])
    assert sorted(r["id"] for r in t.read().collect()) == ["1", "2", "3"]
    t.upsert(spark.createDataFrame([("1", DAYS[1], 10)], SCHEMA), ["id"])
    assert t.commits()[-1]["replaces_null"] and sorted((r["id"], r["v"]) for r in t.read().collect()) == [("1", 10), ("2", 2), ("3", 3)]


def test_a_crash_before_the_commit_leaves_the_index_as_it_was(spark, scratch):
    root = scratch("t")
    t = VersionedTable(spark, root, partition_by="d")
    t.merge_insert(frame(spark, range(3)), ["id"])

    def crash(version, stage):
        if stage == "data":
            raise RuntimeError("crash")
    t.fault = crash
    with pytest.raises(RuntimeError):
        t.merge_insert(frame(spark, [3, 4]), ["id"])
    fresh = VersionedTable(spark, root)
    fresh.merge_insert(frame(spark, [2, 3, 4]), ["id"])     # 3 and 4 were never committed
    assert sorted(r["id"] for r in fresh.read().collect()) == ["0", "1", "2", "3", "4"]


def test_runs_that_were_merged_away_are_deleted(spark, scratch):
    t = VersionedTable(spark, scratch("t"), partition_by="d")
    for step in range(12):
        t.merge_insert(frame(spark, range(step * 2, step * 2 + 3), step), ["id"])
    runs = t.commits()[-1]["key_index"]["runs"]
    for kind in ("keys", "filter"):
        assert sorted(p.rsplit("=", 1)[1] for p in list_subdirs(spark, f"{t.root}/keys/{kind}")) == sorted(r["id"] for r in runs)
    assert t.read().count() == 25 and sum(r["rows"] for r in runs) == 25


FLAT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from eventmart.session import build_session
from eventmart.sinks import key_index
from eventmart.sinks.table import VersionedTable
key_index.BUCKET_ROWS = 256
key_index.KeyIndex.__init__.__defaults__ = (None, 256, 8)
spark = build_session(master="local[4]", shuffle_partitions=4, conf={{
    "spark.checkpoint.dir": {scratch!r}, "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + {scratch!r},
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}})
add = key_index.KeyIndex.add
def described(*args):     # building runs (and merging old ones) apart from looking keys up
    before = spark.sparkContext.getLocalProperty("spark.job.description")
    spark.sparkContext.setJobDescription("add")
    try:
        return add(*args)
    finally:
        spark.sparkContext.setJobDescription(before)
key_index.KeyIndex.add = described
t = VersionedTable(spark, {scratch!r} + "/t")
n = 4000
for step in range(30):
    # three in a thousand keys of a batch were there two batches before
    batch = spark.range(step * n, (step + 1) * n).select(
        F.when((F.col("id") % 1000 < 3) & F.lit(step > 1), F.col("id") - 2 * n + 500).otherwise(F.col("id")).cast("string").alias("id"))
    path = {scratch!r} + f"/batch{{step}}"
    batch.write.parquet(path)
    spark.sparkContext.setJobDescription(f"merge {{step}}")
    t.merge_insert(spark.read.parquet(path), ["id"])
spark.sparkContext.setJobDescription(None)
assert t.read().count() == t.read().distinct().count()
spark.stop()
"""


def test_key_rows_read_for_a_batch_do_not_grow_with_the_table(scratch):
    """From the event log: rows that the scans of the key files gave, merge by merge."""
    folder = scratch("flat")
    os.makedirs(folder)
    code = textwrap.dedent(FLAT).format(root=ROOT, scratch=folder)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=600)
    log = next(f for f in glob.glob(f"{folder}/*") if os.path.isfile(f) and "batch" not in f)
    plans, merges, read = {}, {}, {}

    def walk(node, execution, scans):
        if node["nodeName"].startswith("Scan parquet") and "/keys/keys/run=" in str(node.get("metadata", {})):
            for m in node["metrics"]:
                if m["name"] == "number of output rows":
                    scans[m["accumulatorId"]] = execution
        for child in node["children"]:
            walk(child, execution, scans)

    for line in open(log):
        e = json.loads(line)
        kind = e["Event"].rsplit(".", 1)[-1]
        if kind in ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
            walk(e["sparkPlanInfo"], e["executionId"], plans)
            if "description" in e:
                merges[e["executionId"]] = e["description"]
        elif kind == "SparkListenerTaskEnd":
            for acc in e["Task Info"]["Accumulables"]:
                if acc["ID"] in plans:
                    name = merges[plans[acc["ID"]]]
                    read[name] = read.get(name, 0) + int(acc["Update"])
    steps = [read.get(f"merge {i}", 0) for i in range(30)]
    print(steps, read["add"])
    early, late = sum(steps[5:15]), sum(steps[20:30])
    assert 0 < late < 1.6 * early and max(steps) < 20_000      # the table has 120,000 rows at the end
    assert read["add"] < 120_000 * 8                            # merging runs reads each key a few times in all
