"""Algebraic laws of the merge operators on generated inputs (hypothesis),
checked against plain-Python reference semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.operators import merge as M

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]
SCHEMA = "k long, d date, v string"

rows_st = st.lists(
    st.tuples(st.integers(0, 6), st.sampled_from(DAYS + [None]), st.sampled_from(["a", "b", "c"])),
    max_size=8)
LAW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def as_set(df):
    return sorted((r["k"], str(r["d"]), r["v"]) for r in df.collect())


@LAW
@given(target=rows_st, batch=rows_st)
def test_merge_insert_laws(spark, target, batch):
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    once = M.merge_insert(t, b, ["k"])
    # idempotent: merge(merge(t, b), b) == merge(t, b)
    assert as_set(M.merge_insert(once, b, ["k"])) == as_set(once)
    # target rows are never changed; each new key arrives exactly once
    got = as_set(once)
    target_keys = {k for k, _, _ in target}
    new_keys = {k for k, _, _ in batch if k not in target_keys}
    assert len(got) == len(target) + len(new_keys)
    # the shuffle plan gives the same rows as the broadcast plan
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert as_set(M.merge_insert(t, b, ["k"])) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@LAW
@given(target=rows_st, batch=rows_st)
def test_replace_where_laws(spark, target, batch):
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    once = M.replace_where(t, b, "d")
    assert as_set(M.replace_where(once, b, "d")) == as_set(once)      # replace twice == once
    touched = {d for _, d, _ in batch}
    expected = sorted([(k, str(d), v) for k, d, v in target if d not in touched] +
                      [(k, str(d), v) for k, d, v in batch])
    assert as_set(once) == expected


@LAW
@given(target=rows_st, batch=rows_st)
def test_upsert_law(spark, target, batch):
    # unique, non-null batch keys (the operator rejects anything else)
    seen, uniq = set(), []
    for r in batch:
        if r[0] not in seen:
            seen.add(r[0])
            uniq.append(r)
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(uniq, SCHEMA)
    once = M.upsert(t, b, ["k"])
    assert as_set(M.upsert(once, b, ["k"])) == as_set(once)
    expected = sorted([(k, str(d), v) for k, d, v in target if k not in seen] +
                      [(k, str(d), v) for k, d, v in uniq])
    assert as_set(once) == expected


op_st = st.lists(st.tuples(st.sampled_from(["append", "replace", "overwrite", "delete"]), rows_st),
                 min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ops=op_st)
def test_versioned_table_matches_model(spark, scratch, ops):
    from pyspark.sql import functions as F

    from eventmart.sinks.table import VersionedTable
    t = VersionedTable(spark, scratch("model"), partition_by="d")
    current: list = []
    for op, rows in ops:
        df = spark.createDataFrame(rows, SCHEMA)
        if op == "append":
            t.append(df)
            current = current + rows
        elif op == "replace":
            t.replace_partitions(df)
            touched = {d for _, d, _ in rows}
            current = [r for r in current if r[1] not in touched] + rows
        elif op == "overwrite":
            t.overwrite(df)
            current = list(rows)
        else:
            if not t.exists():
                continue
            t.delete(F.col("v") == "a")
            current = [r for r in current if r[2] != "a"]
        assert as_set(t.read()) == sorted((k, str(d), v) for k, d, v in current)


keyed_st = st.lists(st.tuples(st.integers(0, 4), st.sampled_from([None, 1, 2, 3]),
                              st.integers(0, 50), st.sampled_from(["x", "y", None])), max_size=10)


@LAW
@given(rows=keyed_st)
def test_latest_and_first_per_key_match_model(spark, rows):
    from eventmart.operators import dedup as Dd
    # (k, ts, id, v) with ids made unique so (ts, id) orders completely
    rows = [(k, ts, i * 100 + n, v) for n, (k, ts, i, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, ts long, id long, v string")

    def pick(group, latest):
        present = [r for r in group if r[1] is not None] or group
        if latest:
            return max(present, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        return min(present, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    for latest, op in ((True, Dd.latest_per_key), (False, Dd.first_per_key)):
        want = {}
        for k in {r[0] for r in rows}:
            want[k] = pick([r for r in rows if r[0] == k], latest)[2]
        got = {r["k"]: r["id"] for r in op(df, ["k"], ["ts", "id"]).collect()}
        assert got == want


snap_st = st.lists(st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", None]), max_size=5),
                   min_size=1, max_size=4)


@LAW
@given(snaps=snap_st)
def test_scd2_matches_model(spark, snaps):
    from eventmart.operators import scd2 as S
    history, model = None, []          # model rows: [k, v, valid_from, valid_to]
    for n, state in enumerate(snaps):
        ts = dt.datetime(2024, 1, 1 + n)
        cur = spark.createDataFrame(sorted(state.items()), "k long, v string")
        history = S.snapshot(history, cur, "k", ["v"], ts)
        history = spark.createDataFrame(history.collect(), history.schema)   # cut lineage
        open_rows = {r[0]: r for r in model if r[3] is None}
        for k, v in state.items():
            if k not in open_rows:
                model.append([k, v, ts, None])
            elif open_rows[k][1] != v:
                open_rows[k][3] = ts
                model.append([k, v, ts, None])
    got = sorted((r["k"], str(r["v"]), r["valid_from"], str(r["valid_to"])) for r in history.collect())
    want = sorted((k, str(v), f, str(t)) for k, v, f, t in model)
    assert got == want


@LAW
@given(keys=st.lists(st.sampled_from(["a", "b", "c", None]), max_size=12),
       written_mask=st.lists(st.booleans(), min_size=12, max_size=12))
def test_duplicate_and_reconcile_match_model(spark, keys, written_mask):
    from eventmart.operators import aggregates as A
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    r = A.duplicate_summary(df, "k").collect()[0]
    non_null = [k for k in keys if k is not None]
    assert (r["total"], r["distinct_keys"], r["null_keys"]) == (len(keys), len(set(non_null)), len(keys) - len(non_null))
    assert r["duplicates"] == len(non_null) - len(set(non_null))
    written = [k for k, w in zip(keys, written_mask) if w]
    out = {x["k"]: (x["rows_read"], x["rows_written"], x["ok"])
           for x in A.reconcile_counts(df, spark.createDataFrame([(k,) for k in written], "k string"), "k").collect()}
    for k in set(keys):
        n_r, n_w = keys.count(k), written.count(k)
        assert out[k] == (n_r, n_w, n_r == n_w)
