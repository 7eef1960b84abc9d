"""Driver queries that run the star-schema models on nested archive events.

``nested_events`` builds raw archive events (nested structs, 15-odd payload
fields, blanks, nulls, renamed repos, repeated ids) from the given events;
the queries take them through the batch and the stream flatten, staging, the
intermediate aggregates, the incremental marts and the declared tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.flatten import flatten
from eventmart.plans import models as M
from eventmart.plans.catalog import events, register
from eventmart.plans.warehouse import MARTS, ModelStates, Warehouse, build_models, test_results
from eventmart.schema import CORRUPT_COLUMN, STAGING_COLUMNS, event_schema
from eventmart.session import scratch_path
from eventmart.sinks.replay import write_segments
from eventmart.sinks.table import VersionedTable
from eventmart.sources.files import parse_lines
from eventmart.sources.messages import stream_source
from eventmart.streaming.ingest import build_stream, merge_sink, run_available_now

# Fixture choices: archive event type per event type of the given table.
TYPES = {"click": "PushEvent", "view": "WatchEvent", "purchase": "PullRequestEvent", "signup": "ForkEvent"}
OTHER_TYPE = "IssuesEvent"
MID = dt.date(2024, 1, 16)


def nested_events(spark, sf_dir) -> DataFrame:
    """The given events as raw archive events of the declared schema; the ids
    divisible by 13 come twice, those by 17 once more an hour later."""
    ev = events(spark, sf_dir)
    i, user = F.col("event_id"), F.col("user_id")
    kind = F.lit(OTHER_TYPE)
    for given, named in TYPES.items():
        kind = F.when(F.col("event_type") == given, F.lit(named)).otherwise(kind)
    repo = i % 97
    base = ev.withColumns({"kind": kind, "at": F.col("ts").cast("timestamp"),
                           "actor": F.when(i % 53 != 0, user)})

    def only(name, value):
        return F.when(F.col("kind") == name, value)

    owner_repo = F.concat(F.lit("owner"), repo % 7, F.lit("/repo"), repo,
                          F.when(F.dayofmonth("ts") > 15, F.lit("-renamed ")).otherwise(F.lit("")))
    pull = F.struct((i * 10).alias("id"), F.when(i % 2 == 0, " closed ").otherwise("open").alias("state"), (i % 2 == 0).alias("merged"),
                    F.col("at").alias("created_at"), F.when(i % 2 == 0, F.col("at")).alias("merged_at"))
    payload = F.struct(
        F.when(i % 4 == 0, F.lit("   ")).when(i % 4 == 1, F.lit(" started ")).alias("action"),
        only("PushEvent", F.lit("refs/heads/main")).alias("ref"), F.when(i % 5 == 0, F.lit("branch")).alias("ref_type"),
        only("PushEvent", i).alias("push_id"), only("PushEvent", (i % 9).cast("int")).alias("size"),
        only("PushEvent", (i % 4).cast("int")).alias("distinct_size"), only("PushEvent", F.md5(i.cast("string"))).alias("head"),
        F.lit(None).cast("string").alias("before"), only("PullRequestEvent", (i % 1000).cast("int")).alias("number"),
        only("PullRequestEvent", pull).alias("pull_request"),
        only("IssuesEvent", F.struct(i.alias("id"), (i % 50).cast("int").alias("number"), F.lit("open").alias("state"))).alias("issue"),
        F.lit(None).cast("struct<id: bigint>").alias("comment"),
        only("ForkEvent", F.struct((i + 7).alias("id"), F.concat(F.lit("fork/"), repo).alias("full_name"))).alias("forkee"),
        F.lit(None).cast("struct<id: bigint, tag_name: string>").alias("release"),
        F.lit(None).cast("struct<id: bigint, login: string>").alias("member"))

    def raw(rows):
        return rows.select(
            i.cast("string").alias("id"), F.concat(F.lit(" "), "kind").alias("type"),
            F.struct(F.col("actor").alias("id"), F.concat(F.lit("  user"), "actor", F.lit(" ")).alias("login"),
                     F.concat(F.lit("User "), "actor").alias("display_login"), F.lit("u").alias("url"),
                     F.lit("a").alias("avatar_url")).alias("actor"),
            F.struct(repo.alias("id"), owner_repo.alias("name"), F.lit("r").alias("url")).alias("repo"),
            F.when(i % 3 == 0, F.struct((i % 11).alias("id"), F.concat(F.lit("org"), i % 11).alias("login"), F.lit("o").alias("url"))).alias("org"),
            payload.alias("payload"), (i % 10 != 0).alias("public"), F.col("at").alias("created_at"))

    later = base.filter(i % 17 == 0).withColumn("at", F.col("at") + F.expr("INTERVAL 1 HOUR"))
    return raw(base).unionByName(raw(base.filter(i % 13 == 0))).unionByName(raw(later))


#: the flat rows of nested_events, as SQL
RAW = """
with once as (select event_id i, ts at_, ts, event_type k, user_id u from events
  union all select event_id, ts, ts, event_type, user_id from events where event_id % 13 = 0
  union all select event_id, ts + interval 1 hour, ts, event_type, user_id from events where event_id % 17 = 0),
typed as (select *, case k when 'click' then 'PushEvent' when 'view' then 'WatchEvent' when 'purchase' then 'PullRequestEvent'
  when 'signup' then 'ForkEvent' else 'IssuesEvent' end kind, case when i % 53 <> 0 then u end actor, i % 97 r from once),
raw as (select cast(i as varchar) event_id, ' ' || kind event_type, at_ created_at, cast(at_ as date) event_date, i % 10 <> 0 is_public,
  actor actor_id, '  user' || actor || ' ' actor_login, 'User ' || actor actor_display_login, r repo_id,
  'owner' || (r % 7) || '/repo' || r || case when day(ts) > 15 then '-renamed ' else '' end repo_name,
  case when i % 3 = 0 then i % 11 end org_id, case when i % 3 = 0 then 'org' || (i % 11) end org_login,
  case i % 4 when 0 then '   ' when 1 then ' started ' end action, case when kind = 'PushEvent' then 'refs/heads/main' end as ref,
  case when i % 5 = 0 then 'branch' end ref_type, case when kind = 'PushEvent' then i end push_id,
  case when kind = 'PushEvent' then cast(i % 9 as int) end push_size, case when kind = 'PushEvent' then cast(i % 4 as int) end push_distinct_size,
  case when kind = 'PushEvent' then md5(cast(i as varchar)) end push_head, cast(null as varchar) push_before,
  case when kind = 'PullRequestEvent' then cast(i % 1000 as int) end pr_number, case when kind = 'PullRequestEvent' then i * 10 end pr_id,
  case when kind = 'PullRequestEvent' then case when i % 2 = 0 then ' closed ' else 'open' end end pr_state,
  case when kind = 'PullRequestEvent' then i % 2 = 0 end pr_merged, case when kind = 'PullRequestEvent' then at_ end pr_created_at,
  case when kind = 'PullRequestEvent' and i % 2 = 0 then at_ end pr_merged_at, case when kind = 'IssuesEvent' then i end issue_id,
  case when kind = 'IssuesEvent' then cast(i % 50 as int) end issue_number, case when kind = 'IssuesEvent' then 'open' end issue_state,
  cast(null as bigint) comment_id, case when kind = 'ForkEvent' then i + 7 end forkee_id,
  case when kind = 'ForkEvent' then 'fork/' || r end forkee_full_name, cast(null as bigint) release_id, cast(null as varchar) release_tag,
  cast(null as bigint) member_id, cast(null as varchar) member_login from typed)"""

#: staging over RAW: trimmed texts, blank as null
STG = RAW + """,
stg as (select event_id, trim(event_type) event_type, created_at, event_date, is_public, actor_id, repo_id, org_id,
  nullif(trim(action), '') action, nullif(trim(ref), '') as ref, nullif(trim(ref_type), '') ref_type, push_id, push_size,
  push_distinct_size, pr_number, pr_id, nullif(trim(pr_state), '') pr_state, pr_merged, pr_created_at, pr_merged_at, issue_id,
  issue_number, nullif(trim(issue_state), '') issue_state, comment_id, forkee_id, release_id, member_id from raw)"""


def _wall_clock(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, for the comparison with SQL."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
                           if f.dataType.typeName() == "timestamp"})


def _json(raw: DataFrame) -> Column:
    return F.to_json(F.struct(*raw.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def _flat(spark, sf_dir) -> DataFrame:
    """The raw events through JSON text, the declared schema and flatten."""
    raw = nested_events(spark, sf_dir)
    return flatten(parse_lines(raw.select(_json(raw).alias("value")), event_schema()))


@register("flatten_36", RAW + " select * from raw")
def q_flatten_36(spark, sf_dir):
    return _wall_clock(_flat(spark, sf_dir))


@register("flatten_36_stream", RAW + """
select * from raw where not exists (select 1 from events e where cast(e.event_id as varchar) = raw.event_id and e.ts <> raw.created_at)
qualify row_number() over (partition by event_id) = 1""")
def q_flatten_36_stream(spark, sf_dir):
    """The same flatten in the stream: the first delivery of an id stays; a
    second run brings its repeats, which are late, deduplicated or matched."""
    raw = nested_events(spark, sf_dir)
    first = F.row_number().over(Window.partitionBy("id").orderBy("created_at"))
    ranked = raw.select(F.to_date("created_at").alias("_seg"), _json(raw).alias("value"), (first == 1).alias("_first"))
    landing, root = scratch_path(spark, "flat_landing"), scratch_path(spark, "flat")
    t = VersionedTable(spark, f"{root}/table", partition_by="event_date")
    for delivery in (F.col("_first"), ~F.col("_first")):
        write_segments(ranked.filter(delivery).drop("_first"), landing, "_seg")
        stream = build_stream(stream_source(spark, "files", path=landing), event_schema(), ["event_id"], "created_at",
                              lambda df: flatten(df, keep=[CORRUPT_COLUMN]), corrupt_col=CORRUPT_COLUMN)
        sink = merge_sink(t, ["event_id"], VersionedTable(spark, f"{root}/quarantine"), corrupt_col=CORRUPT_COLUMN)
        run_available_now(spark, stream, sink, f"{root}/checkpoint")
    return _wall_clock(t.read())


@register("stg_events", STG + " select * from stg")
def q_stg_events(spark, sf_dir):
    return _wall_clock(M.stg_events(_flat(spark, sf_dir)))


REPOS = """
repos as (select repo_id, trim(repo_name) repo_name, split_part(trim(repo_name), '/', 1) repo_owner,
  split_part(trim(repo_name), '/', 2) repo_short_name from raw where repo_id is not null
  qualify row_number() over (partition by repo_id order by created_at desc, event_id desc) = 1)"""


@register("stg_repos", RAW + "," + REPOS + " select * from repos")
def q_stg_repos(spark, sf_dir):
    return M.stg_repos(_flat(spark, sf_dir))


DAILY = """
daily as (select cast(repo_id as varchar) || '-' || cast(event_date as varchar) daily_repo_activity_id, repo_id, event_date,
  count(*) total_events, count(distinct actor_id) distinct_actors, count(*) filter (where event_type = 'PushEvent') push_events,
  count(*) filter (where event_type = 'PullRequestEvent') pull_request_events, count(*) filter (where event_type = 'IssuesEvent') issue_events,
  count(*) filter (where event_type = 'WatchEvent') watch_events, count(*) filter (where event_type = 'ForkEvent') fork_events,
  count(*) filter (where event_type = 'ReleaseEvent') release_events from stg where repo_id is not null group by repo_id, event_date)"""


@register("int_daily_repo_activity", STG + "," + DAILY + " select * from daily")
def q_int_daily_repo_activity(spark, sf_dir):
    return M.int_daily_repo_activity(M.stg_events(_flat(spark, sf_dir)))


def _two_builds(spark, sf_dir, name, marts=MARTS) -> tuple[Warehouse, DataFrame]:
    """The warehouse after a build of the days before MID and one that is told the rest."""
    path = scratch_path(spark, f"{name}_raw")
    flatten(nested_events(spark, sf_dir)).write.parquet(path)
    raw, wh = spark.read.parquet(path), Warehouse(scratch_path(spark, name))
    before = F.col("event_date") < F.lit(MID)
    build_models(spark, raw.filter(before), wh, run_tests=False, marts=marts)
    build_models(spark, raw, wh, run_tests=False, marts=marts, delta=raw.filter(~before))
    return wh, raw


@register("fct_events_incremental", STG + """,
f1 as (select * from stg where event_date < date '2024-01-16' qualify row_number() over (partition by event_id order by created_at) = 1),
f2 as (select * from stg where event_date > coalesce((select max(event_date) from f1), date '1900-01-01')
       qualify row_number() over (partition by event_id order by created_at) = 1)
select * from f2 union all select * from f1 where event_id not in (select event_id from f2)""")
def q_fct_events_incremental(spark, sf_dir):
    wh, _ = _two_builds(spark, sf_dir, "fct_incremental", marts=["fct_events"])
    return _wall_clock(wh.table(spark, "fct_events").read().select(*STAGING_COLUMNS))


@register("dim_repos_incremental", STG + "," + REPOS + "," + DAILY + """,
rolled as (select repo_id, min(event_date) first_seen_date, max(event_date) last_seen_date, cast(sum(total_events) as bigint) total_events
           from daily group by repo_id),
early as (select repo_id, min(event_date) first_seen_date, max(event_date) last_seen_date, cast(sum(total_events) as bigint) total_events
          from daily where event_date < date '2024-01-16' group by repo_id),
old_name as (select repo_id, trim(repo_name) repo_name from raw where event_date < date '2024-01-16'
             qualify row_number() over (partition by repo_id order by created_at desc, event_id desc) = 1),
fresh as (select * from rolled where last_seen_date > coalesce((select max(last_seen_date) from early), date '1900-01-01'))
select repo_id, repo_name, repo_owner, repo_short_name, first_seen_date, last_seen_date, total_events from fresh join repos using (repo_id)
union all select e.repo_id, o.repo_name, split_part(o.repo_name, '/', 1), split_part(o.repo_name, '/', 2), e.first_seen_date, e.last_seen_date,
  e.total_events from early e join old_name o using (repo_id) where e.repo_id not in (select repo_id from fresh)""")
def q_dim_repos_incremental(spark, sf_dir):
    wh, _ = _two_builds(spark, sf_dir, "dim_incremental", marts=["dim_repos"])
    return wh.table(spark, "dim_repos").read()


@register("model_tests", STG + """,
fct as (select * from stg qualify row_number() over (partition by event_id order by created_at) = 1),
n as (select (select count(*) from stg where event_type not in ('CommitCommentEvent', 'CreateEvent', 'DeleteEvent', 'ForkEvent', 'GollumEvent',
  'IssueCommentEvent', 'IssuesEvent', 'MemberEvent', 'PublicEvent', 'PullRequestEvent', 'PullRequestReviewCommentEvent',
  'PullRequestReviewEvent', 'PushEvent', 'ReleaseEvent', 'WatchEvent')) unknown,
  (select count(*) from (select event_id from stg group by 1 having count(*) > 1)) repeated,
  (select count(*) from stg where event_id is null) no_id, (select count(*) from stg where event_type is null) no_type,
  (select count(*) from stg where created_at is null) no_time)
select 'stg_events' as model, 'not_null' as test, 'event_id' as col, 'error' as severity, no_id as failures from n
union all select 'stg_events', 'unique', 'event_id', 'warn', repeated from n
union all select 'stg_events', 'not_null', 'event_type', 'error', no_type from n
union all select 'stg_events', 'accepted_values', 'event_type', 'error', unknown from n
union all select 'stg_events', 'not_null', 'created_at', 'error', no_time from n
union all select m, t, c, 'error', 0 from (values
 ('stg_actors', 'not_null', 'actor_id'), ('stg_actors', 'unique', 'actor_id'), ('stg_repos', 'not_null', 'repo_id'), ('stg_repos', 'unique', 'repo_id'),
 ('int_daily_repo_activity', 'not_null', 'daily_repo_activity_id'), ('int_daily_repo_activity', 'unique', 'daily_repo_activity_id'),
 ('int_daily_repo_activity', 'not_null', 'repo_id'), ('int_daily_repo_activity', 'relationships', 'repo_id'),
 ('int_actor_first_last_seen', 'not_null', 'actor_id'), ('int_actor_first_last_seen', 'unique', 'actor_id'),
 ('int_actor_first_last_seen', 'relationships', 'actor_id'), ('fct_events', 'not_null', 'event_id'), ('fct_events', 'unique', 'event_id'),
 ('fct_events', 'relationships', 'repo_id'), ('fct_events', 'relationships', 'actor_id'), ('dim_repos', 'not_null', 'repo_id'),
 ('dim_repos', 'unique', 'repo_id'), ('dim_actors', 'not_null', 'actor_id'), ('dim_actors', 'unique', 'actor_id')) v(m, t, c)""")
def q_model_tests(spark, sf_dir):
    """Every declared test of the warehouse after two incremental builds."""
    wh, raw = _two_builds(spark, sf_dir, "model_tests")
    models = ModelStates(spark, wh).models() | {"stg_events": M.stg_events(raw)}
    return test_results(models | {name: wh.table(spark, name).read() for name in MARTS})


@register("activity_three_increments", STG + "," + DAILY + " select * from daily")
def q_activity_three_increments(spark, sf_dir):
    """Daily activity from a state that got the events in three deltas, by digest of the
    id, so that each brings late rows to every day; the second one comes twice."""
    path = scratch_path(spark, "increments_raw")
    stg = M.stg_events(_flat(spark, sf_dir))
    stg.withColumn("_delta", F.pmod(F.xxhash64("event_id", "created_at"), F.lit(3))).write.partitionBy("_delta").parquet(path)
    state = ModelStates(spark, Warehouse(scratch_path(spark, "increments"))).activity
    for batch, delta in enumerate((0, 1, 1, 2)):
        rows = spark.read.schema(stg.schema).parquet(f"{path}/_delta={delta}")
        merged = state.update(rows, query_id="increments", batch_id=delta)
        if merged != (batch != 2):
            raise RuntimeError("a delta was merged twice or not at all")
    return M.daily_of_activity(state.read())
