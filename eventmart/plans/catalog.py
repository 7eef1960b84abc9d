"""Driver queries: each key builds its adverse input from the given tables and
runs it through the library's operators. ``ORACLES`` holds the matching
DuckDB SQL (the specification) for every key that SQL can express.

The driver tables stand in for the event model: events(event_id, ts,
user_id, event_type, value, props) for flat events, customer/orders for
dimension attributes and activity, documents.text for duplicate keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import clean_text, event_date, ntz, split_part
from eventmart.operators import aggregates as A
from eventmart.operators import dedup as D
from eventmart.operators import incremental as I
from eventmart.operators import merge as M
from eventmart.operators import quality as Q
from eventmart.operators import scd2
from eventmart.operators.flatten import flatten, parse_json_column
from eventmart.session import scratch_path
from eventmart.sinks.table import VersionedTable
from eventmart.sources.files import parse_health, parse_lines

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# Per-type counters of the fixture's daily activity (refund never occurs: 0).
FIXTURE_TYPE_COUNTS = [("clicks", "click"), ("views", "view"), ("purchases", "purchase"),
                       ("signups", "signup"), ("errors", "error"), ("refunds", "refund")]


def event_lines(ev: DataFrame) -> DataFrame:
    """The fixture events as raw JSON message text, one line per event."""
    return ev.select(F.to_json(F.struct(*ev.columns)).alias("value"))


EVENT_LINE_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


# ----------------------------------------------------------------- scans / flatten
@register("flatten_events", """
select event_id, event_type, ts, cast(ts as date) event_date, user_id,
       cast(json_extract_string(props,'$.k') as int) k from events""")
def q_flatten_events(spark, sf_dir):
    ev = parse_json_column(events(spark, sf_dir), "props", "k INT")
    fields = [("event_id", "event_id"), ("event_type", "event_type"), ("ts", "ts"),
              ("user_id", "user_id"), ("props.k", "k")]
    return flatten(ev, fields, ts_col="ts", date_col="event_date")


@register("decode_messages", "select event_id, user_id, event_type from events")
def q_decode_messages(spark, sf_dir):
    from eventmart.sources.messages import decode
    messages = event_lines(events(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    return decode(messages, EVENT_LINE_SCHEMA).select("event_id", "user_id", "event_type")


@register("corrupt_records", """
select count(*) total, count(*) filter (where event_id % 11 = 0) corrupt from events""")
def q_corrupt_records(spark, sf_dir):
    ev = events(spark, sf_dir)
    line = F.to_json(F.struct(*ev.columns))
    # every 11th line is cut short, which no JSON parser accepts
    damaged = F.when(F.col("event_id") % 11 == 0, F.expr("substr(value, 1, length(value) - 1)")) \
        .otherwise(F.col("value"))
    lines = ev.select("event_id", line.alias("value")).select(damaged.alias("value"))
    parsed = parse_lines(lines, EVENT_LINE_SCHEMA, corrupt_col="_corrupt_record")
    return parse_health(parsed, "_corrupt_record")


# ------------------------------------------------------------------- staging
@register("stg_clean", """
select event_id, nullif(trim(case when event_id % 5 = 0 then '   ' else '  ' || event_type || ' ' end), '') event_type,
       cast(ts as date) event_date from events""")
def q_stg_clean(spark, sf_dir):
    ev = events(spark, sf_dir)
    padded = F.when(F.col("event_id") % 5 == 0, F.lit("   ")) \
        .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
    raw = ev.select("event_id", padded.alias("event_type"), "ts")
    return raw.select("event_id", clean_text("event_type").alias("event_type"),
                      event_date("ts").alias("event_date"))


@register("split_owner", """
select c_custkey, split_part(trim(c_name), '#', 1) owner, split_part(trim(c_name), '#', 2) short_name,
       split_part(c_name, '#', 3) missing from customer""")
def q_split_owner(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    split_part(F.trim("c_name"), "#", 1).alias("owner"),
                    split_part(F.trim("c_name"), "#", 2).alias("short_name"),
                    split_part("c_name", "#", 3).alias("missing"))


@register("stg_latest_per_key", """
select user_id, event_id, event_type, value from events where user_id is not null
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def q_stg_latest_per_key(spark, sf_dir):
    ev = D.drop_null_keys(events(spark, sf_dir), ["user_id"])
    latest = D.latest_per_key(ev.select("user_id", "event_id", "event_type", "value", "ts"),
                              ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", "value")


@register("fct_first_per_key", """
with e as (select event_id, ts, user_id, event_type from events
           union all select event_id, ts + interval 1 hour, user_id, event_type from events where event_id % 7 = 0)
select event_id, ts, user_id, event_type from e
qualify row_number() over (partition by event_id order by ts, user_id) = 1""")
def q_fct_first_per_key(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    later = ev.filter(F.col("event_id") % 7 == 0) \
        .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return D.first_per_key(ev.unionByName(later), ["event_id"], ["ts", "user_id"])


# ---------------------------------------------------------------- aggregates
@register("daily_activity", """
select cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) daily_id, user_id, cast(ts as date) event_date,
 count(*) total_events, count(distinct event_type) distinct_types,
 count(*) filter (where event_type='click') clicks, count(*) filter (where event_type='view') views,
 count(*) filter (where event_type='purchase') purchases, count(*) filter (where event_type='signup') signups,
 count(*) filter (where event_type='error') errors, count(*) filter (where event_type='refund') refunds
from events where user_id is not null group by user_id, cast(ts as date)""")
def q_daily_activity(spark, sf_dir):
    return A.daily_activity(events(spark, sf_dir), key="user_id", ts_col="ts", type_col="event_type",
                            type_counts=FIXTURE_TYPE_COUNTS, distinct_col="event_type",
                            distinct_name="distinct_types", id_name="daily_id")


@register("first_last_seen", """
select user_id, min(ts) first_seen_at, max(ts) last_seen_at, min(cast(ts as date)) first_seen_date,
       max(cast(ts as date)) last_seen_date, count(*) total_events
from events where user_id is not null group by user_id""")
def q_first_last_seen(spark, sf_dir):
    return A.first_last_seen(events(spark, sf_dir), "user_id", "ts")


@register("dim_actors", """
with s as (select user_id, min(ts) first_seen_at, max(ts) last_seen_at, count(*) total_events from events group by user_id),
a as (select user_id, event_type last_type from events
      qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select a.user_id, a.last_type, s.first_seen_at, s.last_seen_at, s.total_events from s join a on a.user_id = s.user_id""")
def q_dim_actors(spark, sf_dir):
    from eventmart.plans.models import dim_actors
    ev = events(spark, sf_dir)
    summary = A.first_last_seen(ev, "user_id", "ts", drop_null_key=False) \
        .select("user_id", "first_seen_at", "last_seen_at", "total_events")
    latest = D.latest_per_key(ev.select("user_id", "event_type", "ts", "event_id"),
                              ["user_id"], ["ts", "event_id"]) \
        .select("user_id", F.col("event_type").alias("last_type"))
    return dim_actors(summary, latest, key="user_id") \
        .select("user_id", "last_type", "first_seen_at", "last_seen_at", "total_events")


@register("dim_rollup", """
with d as (select o_custkey, cast(o_orderdate as date) d, count(*) n from orders group by 1, 2)
select c_custkey, c_name, c_mktsegment, min(d) first_date, max(d) last_date, cast(sum(n) as bigint) total_orders
from d join customer on c_custkey = o_custkey group by c_custkey, c_name, c_mktsegment""")
def q_dim_rollup(spark, sf_dir):
    from eventmart.plans.models import dim_rollup
    orders = table(spark, sf_dir, "orders")
    daily = orders.groupBy(F.col("o_custkey"), event_date("o_orderdate").alias("d")) \
        .agg(F.count(F.lit(1)).alias("n"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return dim_rollup(daily, cust, daily_key="o_custkey", dim_key="c_custkey",
                      dim_cols=["c_name", "c_mktsegment"], date_col="d", count_col="n",
                      first_name="first_date", last_name="last_date", total_name="total_orders")


# --------------------------------------------------------------- incremental
@register("incremental_fct", """
select event_id, user_id, cast(ts as date) event_date from events
where cast(ts as date) > (select max(cast(ts as date)) from events where ts < timestamp '2024-01-16')""")
def q_incremental_fct(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "user_id", event_date("ts").alias("event_date"))
    loaded = events(spark, sf_dir).filter(F.col("ts") < ntz(dt.datetime(2024, 1, 16))) \
        .select(event_date("ts").alias("event_date"))
    mark = I.high_water_mark(loaded, "event_date")
    return I.after_mark(ev, "event_date", mark)


@register("incremental_dim_having", """
select user_id, min(cast(ts as date)) first_seen_date, max(cast(ts as date)) last_seen_date, count(*) total_events
from events group by user_id
having max(cast(ts as date)) > (select max(cast(ts as date)) from events where ts < timestamp '2024-01-30')""")
def q_incremental_dim_having(spark, sf_dir):
    ev = events(spark, sf_dir)
    loaded = ev.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 30))).select(event_date("ts").alias("d"))
    mark = I.high_water_mark(loaded, "d")
    summary = A.first_last_seen(ev, "user_id", "ts", drop_null_key=False) \
        .select("user_id", "first_seen_date", "last_seen_date", "total_events")
    return I.groups_after_mark(summary, "last_seen_date", mark)


# -------------------------------------------------------------------- merges
@register("insert_only_merge", """
select o_orderkey, case when o_orderkey % 2 = 0 then o_totalprice else o_totalprice + 1 end o_totalprice from orders""")
def q_insert_only_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    # target already holds the odd keys at a different price; the batch is
    # every order, so odd keys match (kept as they are) and even keys insert
    target = orders.filter(F.col("o_orderkey") % 2 == 1) \
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return M.merge_insert(target, orders, ["o_orderkey"])


@register("upsert_merge", """
select c_custkey, case when c_custkey % 3 = 0 then 'NEW' else c_mktsegment end c_mktsegment
from customer where c_custkey % 2 = 1 or c_custkey % 3 = 0""")
def q_upsert_merge(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    target = cust.filter(F.col("c_custkey") % 2 == 1)
    batch = cust.filter(F.col("c_custkey") % 3 == 0).withColumn("c_mktsegment", F.lit("NEW"))
    return M.upsert(target, batch, ["c_custkey"])


@register("delete_where", """
select event_id, event_type from events where not coalesce(event_type = 'error', false)""")
def q_delete_where(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "event_type")
    return M.delete_where(ev, F.col("event_type") == "error")


# ----------------------------------------------------------------- duplicates
@register("duplicate_summary", """
select count(*) total, count(distinct text) distinct_keys,
       count(*) - count(distinct text) - count(*) filter (where text is null) duplicates,
       count(*) filter (where text is null) null_keys from documents""")
def q_duplicate_summary(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # Documents run to 20,000 words: group on a 256-bit digest (null stays
    # null) so the shuffle moves 32 bytes per row instead of whole texts.
    return A.duplicate_summary(docs, F.sha2(F.col("text"), 256))


@register("duplicate_report", """
select md5(text) text_md5, count(*) n from documents group by text having count(*) > 1
order by n desc, text_md5 limit 10""")
def q_duplicate_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    keys = [F.md5("text").alias("text_md5"), F.sha2(F.col("text"), 256).alias("_sha")]
    return A.duplicate_report(docs, keys, top=10, order_cols=["text_md5"], hidden=["_sha"])


@register("unknown_values", """
select distinct event_type from events where event_type not in ('click', 'view', 'purchase')""")
def q_unknown_values(spark, sf_dir):
    return A.unknown_values(events(spark, sf_dir), "event_type", ["click", "view", "purchase"])


# -------------------------------------------------------------------- quality
@register("dq_conditional_null", """
with e as (select event_type, case when event_type = 'purchase' and event_id % 50 <> 0 then value
                                    when event_type <> 'purchase' and event_id % 70 = 0 then value end amount from events)
select count(*) filter (where event_type = 'purchase' and amount is null) missing,
       count(*) filter (where event_type <> 'purchase' and amount is not null) leaked from e""")
def q_dq_conditional_null(spark, sf_dir):
    ev = events(spark, sf_dir)
    is_purchase = F.col("event_type") == "purchase"
    amount = F.when(is_purchase & (F.col("event_id") % 50 != 0), F.col("value")) \
        .when(~is_purchase & (F.col("event_id") % 70 == 0), F.col("value"))
    e = ev.select("event_type", amount.alias("amount"))
    return Q.conditional_null_counts(e, "amount", F.col("event_type") == "purchase")


@register("dq_relationships", """
select count(*) failures from orders where o_custkey is not null
and o_custkey not in (select c_custkey from customer where c_custkey % 10 <> 0)""")
def q_dq_relationships(spark, sf_dir):
    parent = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 10 != 0)
    return Q.relationship_failures(table(spark, sf_dir, "orders"), "o_custkey", parent, "c_custkey")


@register("dq_suite", """
with e as (select case when event_id % 100 = 0 then null else user_id end user_id, event_type, event_id // 2 as half_id from events)
select 'not_null' as test, 'user_id' as col, 'error' as severity, count(*) filter (where user_id is null) failures from e
union all select 'unique', 'half_id', 'warn', (select count(*) from (select half_id from e where half_id is not null group by 1 having count(*) > 1))
union all select 'accepted_values', 'event_type', 'error', (select count(*) from e where event_type not in ('click', 'view', 'purchase', 'signup'))""")
def q_dq_suite(spark, sf_dir):
    ev = events(spark, sf_dir)
    e = ev.select(F.when(F.col("event_id") % 100 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
                  "event_type", F.expr("event_id div 2").alias("half_id"))
    tests = [Q.not_null("user_id"), Q.unique("half_id", severity=Q.WARN),
             Q.accepted_values("event_type", ["click", "view", "purchase", "signup"])]
    return Q.run_tests(e, tests)


@register("reconcile_counts", """
with r as (select cast(ts as date) event_date, count(*) n from events group by 1),
     w as (select cast(ts as date) event_date, count(*) n from events where event_id % 50 <> 0 group by 1)
select event_date, coalesce(r.n, 0) rows_read, coalesce(w.n, 0) rows_written,
       coalesce(r.n, 0) = coalesce(w.n, 0) ok from r full join w using (event_date)""")
def q_reconcile_counts(spark, sf_dir):
    ev = events(spark, sf_dir).select(event_date("ts").alias("event_date"), "event_id")
    written = ev.filter(F.col("event_id") % 50 != 0)
    return A.reconcile_counts(ev, written, "event_date")


# ---------------------------------------------------------------------- SCD-2
@register("scd2_snapshot", """
select c_custkey, c_mktsegment, timestamp '2024-01-01' valid_from,
       case when c_custkey % 10 = 0 then timestamp '2024-01-02' end valid_to from customer where c_custkey % 3 <> 0
union all select c_custkey, case when c_custkey % 10 = 0 then 'CHANGED' else c_mktsegment end,
       timestamp '2024-01-02', cast(null as timestamp) from customer where c_custkey % 3 = 0 or c_custkey % 10 = 0""")
def q_scd2_snapshot(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    t1 = cust.filter(F.col("c_custkey") % 3 != 0)
    t2 = cust.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 0, F.lit("CHANGED"))
                         .otherwise(F.col("c_mktsegment")))
    hist = VersionedTable(spark, scratch_path(spark, "scd2"), partition_by=scd2.IS_OPEN)
    # the third snapshot finds nothing new
    for day, state in ((1, t1), (2, t2), (3, t2)):
        scd2.snapshot_table(hist, state, "c_custkey", ["c_mktsegment"], dt.datetime(2024, 1, day))
    return hist.read().select("c_custkey", "c_mktsegment", "valid_from", "valid_to")


# storage- and stream-backed keys register themselves on import
from eventmart.plans import catalog_models, catalog_stateful  # noqa: E402,F401
