"""Equality of contents: fingerprints, exports and runs that differ in one row only."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from eventmart.operators import scd2
from eventmart.operators.fingerprint import add_up, differences, fingerprint
from eventmart.plans.daily import reconcile_runs
from eventmart.sinks import export as E
from eventmart.sinks.table import VersionedTable, list_subdirs

SCHEMA = "d date, k long, v string"
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
rows_st = st.lists(st.tuples(st.sampled_from(DAYS), st.sampled_from([1, 2, None]), st.sampled_from(["a", "", None])), max_size=8)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=rows_st, right=rows_st)
def test_equal_fingerprints_mean_equal_rows(spark, left, right):
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in (left, right))
    wrong = {r["d"] for r in differences(fingerprint(a, ["d"]), fingerprint(b, ["d"]), ["d"]).collect()}
    assert wrong == {d for d in DAYS if sorted(map(repr, [r for r in left if r[0] == d])) != sorted(map(repr, [r for r in right if r[0] == d]))}
    random.Random(0).shuffle(left)
    again = spark.createDataFrame(left, SCHEMA).repartition(3).select("v", "d", "k")     # other order, other partitions
    assert differences(fingerprint(a), fingerprint(again)).count() == 0
    parts = fingerprint(a, ["d"])
    assert differences(fingerprint(a), add_up(parts)).count() == 0


def test_an_export_with_other_rows_of_equal_number_fails(spark, scratch, monkeypatch):
    t = VersionedTable(spark, scratch("t"), partition_by="d")
    t.append(spark.createDataFrame([(DAYS[0], 1, "a"), (DAYS[1], 2, "b"), (None, 3, "c")], SCHEMA))
    dest = scratch("out")
    assert E.export_snapshot(t, dest) == 3
    real = E._as_in_paths

    def damaged(df, part):      # the export's files, with one value changed
        out = real(df, part)
        return out.withColumn("v", F.when(F.col("k") == 2, F.lit("B")).otherwise(F.col("v"))) if dest in str(df.inputFiles()) else out
    monkeypatch.setattr(E, "_as_in_paths", damaged)
    with pytest.raises(E.ExportMismatch, match="2024-01-02"):
        E.export_snapshot(t, dest)


def test_export_of_touched_partitions_leaves_the_others(spark, scratch):
    t = VersionedTable(spark, scratch("t"), partition_by="d")
    t.append(spark.createDataFrame([(DAYS[0], 1, "a"), (DAYS[1], 2, "b"), (None, 3, "c")], SCHEMA))
    dest = scratch("out")
    E.export_snapshot(t, dest)
    files = {p: sorted(f for f in spark.read.parquet(dest).inputFiles() if p in f) for p in ("2024-01-01", "2024-01-02", "HIVE")}
    t.merge_insert(spark.createDataFrame([(DAYS[1], 9, "x"), (None, 10, "y")], SCHEMA), ["k"])
    assert E.export_snapshot(t, dest, only=["2024-01-02", None]) == 4
    assert sorted(r["k"] for r in E.read_export(spark, dest).collect()) == [1, 2, 3, 9, 10]
    now = spark.read.parquet(dest).inputFiles()
    assert sorted(f for f in now if "2024-01-01" in f) == files["2024-01-01"] and not set(files["2024-01-02"]) & set(now)
    assert E.export_snapshot(t, dest, only=[]) == 0
    flat = VersionedTable(spark, scratch("flat"))
    flat.append(spark.createDataFrame([(1,)], "k long"))
    with pytest.raises(ValueError):
        E.export_snapshot(flat, scratch("out"), only=["a"])


def test_runs_with_equal_counts_but_other_rows_are_told_apart(spark):
    layers = "layer string, n long, n_keys long, sum_a decimal(38,0), sum_b decimal(38,0)"
    def runs(*rows):
        return spark.createDataFrame([(layer, 3, 3, Decimal(x), Decimal(y)) for layer, x, y in rows], layers)
    a, b = runs(("table", 7, 8), ("fct", 1, 2)), runs(("table", 7, 8), ("fct", 1, 3))
    assert {r["layer"]: r["ok"] for r in reconcile_runs(a, b).collect()} == {"table": True, "fct": False}


def test_snapshots_write_a_closed_row_once(spark, scratch):
    t = VersionedTable(spark, scratch("hist"), partition_by=scd2.IS_OPEN)
    states = [{1: "a", 2: "b"}, {1: "A", 2: "b"}, {1: "A", 2: "B", 3: "c"}, {2: "B"}, {1: "z"}]
    whole = None
    for day, state in enumerate(states, 1):
        current = spark.createDataFrame(sorted(state.items()), "k long, v string")
        scd2.snapshot_table(t, current, "k", ["v"], dt.datetime(2024, 1, day))
        whole = scd2.snapshot(whole, current, "k", ["v"], dt.datetime(2024, 1, day))
    columns = ["k", "v", *scd2.HISTORY_COLUMNS]
    assert sorted(map(repr, t.read().select(*columns).collect())) == sorted(map(repr, whole.select(*columns).collect()))
    closed = []
    for c in t.commits():
        folder = f"{t.data_root}/_version={c['version']}/_attempt={c['attempt']}"
        for part in list_subdirs(spark, folder):
            if part.endswith("is_open=false"):
                closed += [(r["k"], r["valid_from"]) for r in spark.read.parquet(part).collect()]
    assert len(closed) == len(set(closed)) == 3          # each in the commit that closed it, and in no other
