"""One key holding a third (or more) of all rows: results stay exact and the
per-key operators pre-aggregate before the shuffle (no task receives the hot
key's raw rows)."""

import datetime as dt

from pyspark.sql import functions as F

from eventmart.operators import aggregates as A
from eventmart.operators import dedup as D
from eventmart.operators import merge as M


def skewed(spark, n=3000):
    # key 0 holds half the rows; the rest spread over 500 keys
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("event_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(secs=F.col("id"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, "click").otherwise("view").alias("t"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_latest_is_exact_and_partial(spark):
    df = skewed(spark)
    latest = D.latest_per_key(df, ["k"], ["ts", "event_id"])
    got = {r["k"]: r["event_id"] for r in latest.collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("event_id").alias("m")).collect()}
    assert got == want
    p = plan(latest)
    assert "partial_max_by" in p    # map-side combine before the exchange


def test_hot_key_daily_activity_partial(spark):
    df = skewed(spark)
    out = A.daily_activity(df, "k", "ts", "t", [("clicks", "click")], "t", "n_types", "id")
    total = out.agg(F.sum("total_events")).collect()[0][0]
    assert total == df.count()
    assert "partial_count" in plan(out)


def test_hot_key_merge_matches_shuffle_plan(spark):
    df = skewed(spark).select("k", "event_id")
    target = df.filter(F.col("event_id") % 4 == 0)
    batch = df.filter(F.col("event_id") % 4 != 1)
    bcast = M.merge_insert(target, batch, ["event_id"]).count()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = M.merge_insert(target, batch, ["event_id"]).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert bcast == shuffled == df.filter(F.col("event_id") % 4 != 1).count()
