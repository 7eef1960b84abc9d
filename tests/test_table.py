import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart.plans.materialize import materialize_incremental
from eventmart.sinks.export import export_snapshot, read_export
from eventmart.sinks.table import CommitConflict, VersionedTable, create_text, session_conf

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
SCHEMA = "id long, event_date date, v string"


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_replaced_rows_leave_and_others_stay(spark, scratch):
    t = VersionedTable(spark, scratch("vt"), partition_by="event_date")
    t.append(spark.createDataFrame([(1, D1, "a"), (2, D2, "a"), (3, None, "a")], SCHEMA))   # v0
    t.replace_partitions(spark.createDataFrame([(20, D2, "b")], SCHEMA))                   # v1
    assert ids(t.read()) == [1, 3, 20]
    t.replace_partitions(spark.createDataFrame([(30, None, "b")], SCHEMA))                 # v2 null date
    assert ids(t.read()) == [1, 20, 30]
    t.append(spark.createDataFrame([(4, D3, "c")], SCHEMA))                                # v3
    assert ids(t.read()) == [1, 4, 20, 30]
    assert ids(t.read_after(2)) == [4] and ids(t.read_after(None)) == [1, 4, 20, 30]
    t.replace_partitions(spark.createDataFrame([], SCHEMA))                                 # v4 touches nothing
    assert ids(t.read()) == [1, 4, 20, 30]
    t.overwrite(spark.createDataFrame([(9, D1, "z")], SCHEMA))                              # v5 all
    assert ids(t.read()) == [9] and t.read_after(5).count() == 0


def test_superseded_files_are_pruned_at_listing(spark, scratch):
    t = VersionedTable(spark, scratch("prune"), partition_by="event_date")
    t.append(spark.createDataFrame([(1, D1, "a"), (2, D2, "a")], SCHEMA))
    t.replace_partitions(spark.createDataFrame([(3, D1, "b")], SCHEMA))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_version" in plan


def test_upsert_and_delete_rewrite_only_touched_partitions(spark, scratch):
    t = VersionedTable(spark, scratch("ups"), partition_by="event_date")
    t.append(spark.createDataFrame([(1, D1, "a"), (2, D2, "a"), (3, D3, "a")], SCHEMA))
    t.upsert(spark.createDataFrame([(2, D2, "B"), (5, D1, "new")], SCHEMA), ["id"])
    assert {r["id"]: r["v"] for r in t.read().collect()} == {1: "a", 2: "B", 3: "a", 5: "new"}
    assert t.commits()[-1]["replaced_parts"] == ["2024-01-02"]      # key 5 is new: its date gets rows, none is rewritten
    t.delete(F.col("v") == "a")
    assert ids(t.read()) == [2, 5]


def test_uncommitted_version_is_invisible_and_retry_reuses_it(spark, scratch):
    root = scratch("crash")
    t = VersionedTable(spark, root, partition_by="event_date")
    t.append(spark.createDataFrame([(1, D1, "a")], SCHEMA))

    def crash(version, stage):
        if stage == "data":
            raise RuntimeError("crash")
    t.fault = crash
    with pytest.raises(RuntimeError):
        t.append(spark.createDataFrame([(2, D1, "b")], SCHEMA))
    fresh = VersionedTable(spark, root)
    assert ids(fresh.read()) == [1] and fresh.version() == 0
    assert fresh.append(spark.createDataFrame([(3, D2, "c")], SCHEMA)) == 1
    assert ids(fresh.read()) == [1, 3]
    with pytest.raises(CommitConflict):
        create_text(spark, f"{root}/commits/{1:020d}.json", "{}")


def test_export_is_single_version_and_repeatable(spark, scratch):
    t = VersionedTable(spark, scratch("src"), partition_by="event_date")
    t.append(spark.createDataFrame([(1, D1, "a"), (2, D2, "a")], SCHEMA))
    t.replace_partitions(spark.createDataFrame([(3, D1, "b")], SCHEMA))
    dest = scratch("export")
    assert export_snapshot(t, dest) == 2
    assert export_snapshot(t, dest) == 2
    assert ids(read_export(spark, dest)) == [2, 3]
    with pytest.raises(ValueError):
        export_snapshot(t, t.root + "/export")


def test_incremental_first_build_then_merge(spark, scratch):
    fct = VersionedTable(spark, scratch("fct"), partition_by="event_date")
    src = spark.createDataFrame([(1, D1, "a"), (1, D1, "a"), (2, D2, "a")], SCHEMA)

    def build(mark):
        fresh = src if mark is None else src.filter(F.col("event_date") > F.lit(mark))
        return fresh.dropDuplicates(["id"])
    materialize_incremental(build, fct, ["id"], "event_date")
    assert ids(fct.read()) == [1, 2]
    src = src.unionByName(spark.createDataFrame([(2, D3, "moved"), (4, D3, "x")], SCHEMA))
    materialize_incremental(build, fct, ["id"], "event_date")
    assert {r["id"]: r["v"] for r in fct.read().collect()} == {1: "a", 2: "moved", 4: "x"}


def test_create_if_missing_bootstraps_empty(spark, scratch):
    t = VersionedTable(spark, scratch("boot"), partition_by="event_date")
    from pyspark.sql.types import StructType
    assert t.create_if_missing(StructType.fromDDL(SCHEMA)) is True
    assert t.create_if_missing(StructType.fromDDL(SCHEMA)) is False
    assert t.read().count() == 0 and t.read().columns == ["id", "event_date", "v"]


def test_stale_handle_does_not_clobber_a_committed_version(spark, scratch):
    root = scratch("two_handles")
    a = VersionedTable(spark, root, partition_by="event_date")
    a.append(spark.createDataFrame([(1, D1, "a")], SCHEMA))
    b = VersionedTable(spark, root)
    b.commits()                                           # b caches version 0
    a.append(spark.createDataFrame([(2, D1, "a")], SCHEMA))   # version 1 by a
    assert b.append(spark.createDataFrame([(3, D2, "b")], SCHEMA)) == 2
    assert ids(VersionedTable(spark, root).read()) == [1, 2, 3]


def test_bucketed_upsert_exchanges_the_batch_only(spark, scratch):
    plain = VersionedTable(spark, scratch("plain"), partition_by="event_date")
    t = VersionedTable(spark, scratch("bucketed"), partition_by="event_date", bucket_by=(["id"], 4))
    days = [D1, D2, D3, None]
    base = spark.createDataFrame([(i, days[i % 4], "a") for i in range(200)], SCHEMA)
    first = spark.createDataFrame([(i, days[(i + 1) % 4], "b") for i in range(150, 260, 3)], SCHEMA)
    second = spark.createDataFrame([(i, D2, "c") for i in range(0, 300, 7)], SCHEMA)
    for table in (plain, t):
        table.append(base)
        table.upsert(first, ["id"])
        VersionedTable(spark, table.root).upsert(second, ["id"])          # another handle knows the buckets from the commits
    assert VersionedTable(spark, t.root).bucket_by == (["id"], 4)

    def visible(table):
        return sorted((r["id"], str(r["event_date"]), r["v"]) for r in VersionedTable(spark, table.root).read().collect())
    assert visible(t) == visible(plain) and len(visible(t)) == len({i for i, *_ in visible(t)})
    t = VersionedTable(spark, t.root)
    assert sorted((r["id"], str(r["event_date"]), r["v"]) for r in t._read_bucketed().collect()) == visible(t)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        joined = t._read_bucketed().join(second.select("id"), "id", "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_a_bucketed_table_replaces_merges_and_deletes_like_others(spark, scratch):
    t = VersionedTable(spark, scratch("bucketed"), partition_by="event_date", bucket_by=(["id"], 2))
    t.create_if_missing(spark.createDataFrame([], SCHEMA).schema)
    t.merge_insert(spark.createDataFrame([(1, D1, "a"), (2, D2, "a")], SCHEMA), ["id"])
    t.merge_insert(spark.createDataFrame([(2, D3, "x"), (3, D3, "a")], SCHEMA), ["id"])
    t.replace_partitions(spark.createDataFrame([(4, D1, "b")], SCHEMA))
    assert ids(t.read()) == [2, 3, 4]
    t.delete(F.col("id") == 3)
    assert ids(t.read()) == ids(t._read_bucketed()) == [2, 4]
    assert [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("eventmart_")] == []
