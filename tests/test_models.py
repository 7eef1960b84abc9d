"""The star-schema models on a hand-made flat event table shaped like the
warehouse raw table (the reference's 36-column contract)."""

import datetime as dt

from pyspark.sql import functions as F

from eventmart.plans import models
from eventmart.schema import events_contract


def raw_events(spark):
    schema = events_contract()
    base = {f.name: None for f in schema.fields}

    def ev(i, typ, hour, actor, repo, login, name, action=None):
        r = dict(base)
        r.update(event_id=str(i), event_type=f" {typ} ", created_at=dt.datetime(2024, 1, 15, hour),
                 actor_id=actor, actor_login=f" {login} ", actor_display_login=login,
                 repo_id=repo, repo_name=f" {name} ", action=action)
        return r
    rows = [
        ev(1, "PushEvent", 1, 10, 100, "ann", "ann/x"),
        ev(2, "WatchEvent", 2, 11, 100, "bob", "ann/x", action="  "),
        ev(3, "PushEvent", 3, 10, 100, "ann2", "ann/x-renamed"),
        ev(3, "PushEvent", 3, 10, 100, "ann2", "ann/x-renamed"),     # upstream byte-identical copy
        ev(4, "ForkEvent", 23, 12, 200, "cy", "cy/y"),
    ]
    return spark.createDataFrame(rows, schema)


def test_staging_and_marts(spark):
    raw = raw_events(spark)
    stg = models.stg_events(raw)
    assert len(stg.columns) == 27
    r = {x["event_id"]: x for x in stg.collect()}
    assert r["1"]["event_type"] == "PushEvent" and r["2"]["action"] is None
    assert str(r["4"]["event_date"]) == "2024-01-15"

    actors = {x["actor_id"]: x["actor_login"] for x in models.stg_actors(raw).collect()}
    assert actors == {10: "ann2", 11: "bob", 12: "cy"}
    repos = {x["repo_id"]: (x["repo_name"], x["repo_owner"], x["repo_short_name"])
             for x in models.stg_repos(raw).collect()}
    assert repos[100] == ("ann/x-renamed", "ann", "x-renamed")

    daily = models.int_daily_repo_activity(stg)
    d = {x["repo_id"]: x for x in daily.collect()}
    assert d[100]["daily_repo_activity_id"] == "100-2024-01-15"
    assert (d[100]["total_events"], d[100]["distinct_actors"], d[100]["push_events"],
            d[100]["watch_events"]) == (4, 2, 3, 1)

    fct = models.fct_events(stg)
    assert fct.count() == 4 and fct.select("event_id").distinct().count() == 4

    assert {x["repo_id"]: x["total_events"]
            for x in models.int_daily_repo_activity(stg, dedupe=True).collect()}[100] == 3
    first_last = models.int_actor_first_last_seen(stg)
    dim_a = {x["actor_id"]: x for x in models.dim_actors_model(first_last, models.stg_actors(raw)).collect()}
    assert dim_a[10]["total_events"] == 3 and dim_a[10]["actor_login"] == "ann2"

    dim_r = {x["repo_id"]: x for x in models.dim_repos_model(daily, models.stg_repos(raw)).collect()}
    assert dim_r[100]["total_events"] == 4 and dim_r[200]["repo_owner"] == "cy"
    # incremental: nothing after the mark
    mark = dt.date(2024, 1, 15)
    assert models.dim_repos_model(daily, models.stg_repos(raw), mark).count() == 0
    assert models.fct_events(stg, mark).count() == 0


def test_dim_actors_join_adds_no_exchange(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from eventmart.operators import aggregates as A
    from eventmart.operators import dedup as D
    summary = A.first_last_seen(ev, "user_id", "ts")
    latest = D.latest_per_key(ev.select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    joined = models.dim_actors(summary, latest, "user_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange per aggregate, none for the join itself
    assert plan.count("Exchange hashpartitioning") == 2
    assert F  # keep import used


def test_build_models_incremental_and_snapshot(spark, scratch):
    from pyspark.sql import functions as F

    from eventmart.operators.quality import DataTestFailure
    from eventmart.plans.warehouse import Warehouse, build_models, snapshot_repos
    raw = raw_events(spark).withColumn("event_type", F.trim("event_type"))
    wh = Warehouse(scratch("wh"))
    out = build_models(spark, raw, wh)
    # the staging uniqueness test is a warning (one upstream repeat), not an error
    assert [w["test"] for w in out["warnings"]] == ["unique"]
    assert wh.table(spark, "fct_events").read().count() == 4
    # a later day: the fact grows, the repo dimension updates in place
    later = raw.filter(F.col("event_id") == "4").withColumn("event_id", F.lit("5")) \
        .withColumn("created_at", F.lit(dt.datetime(2024, 1, 16, 5)))
    build_models(spark, raw.unionByName(later), wh)
    assert wh.table(spark, "fct_events").read().count() == 5
    dims = {r["repo_id"]: r for r in wh.table(spark, "dim_repos").read().collect()}
    assert dims[200]["total_events"] == 2 and str(dims[200]["last_seen_date"]) == "2024-01-16"
    assert wh.table(spark, "dim_repos").read().count() == 2
    # an unknown event type is an error-severity failure and stops the build
    bad = raw.withColumn("event_type", F.lit("NotAType"))
    try:
        build_models(spark, bad, Warehouse(scratch("wh2")))
        raise AssertionError("expected a data test failure")
    except DataTestFailure as exc:
        assert any(f["test"] == "accepted_values" for f in exc.failed)
    # SCD-2 snapshot: rename of repo 200 opens a second version
    snapshot_repos(spark, raw, wh, dt.datetime(2024, 1, 15))
    renamed = raw.withColumn("repo_name", F.when(F.col("repo_id") == 200, " cy/z ").otherwise(F.col("repo_name")))
    snapshot_repos(spark, renamed, wh, dt.datetime(2024, 1, 16))
    hist = wh.table(spark, "dim_repos_snapshot").read()
    assert hist.filter("repo_id = 200").count() == 2 and hist.filter("valid_to is null").count() == 2
