"""Star-schema models over the flat event table, as DataFrame functions.

staging (row grain, light cleaning) -> intermediate (aggregates) -> marts
(fact at event grain, dimensions at actor / repo grain). Each function takes
DataFrames and returns a DataFrame; nothing is materialised until a sink
writes it, so one Catalyst plan spans from the raw table to a mart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import clean_text, event_date, split_part, surrogate_key
from eventmart.operators import aggregates as A
from eventmart.operators import dedup as D
from eventmart.operators import incremental as I
from eventmart.schema import STAGING_COLUMNS, STAGING_TEXT_COLUMNS

# Daily repo activity counts, (output column, event type) -- fixed values.
REPO_ACTIVITY_TYPES = [
    ("push_events", "PushEvent"), ("pull_request_events", "PullRequestEvent"),
    ("issue_events", "IssuesEvent"), ("watch_events", "WatchEvent"),
    ("fork_events", "ForkEvent"), ("release_events", "ReleaseEvent"),
]


# ------------------------------------------------------------------- staging
def stg_events(raw: DataFrame) -> DataFrame:
    """27 columns; free text trimmed with blank -> null; the date recomputed
    from the timestamp (a path-only partition value loads as null)."""
    cols = []
    for c in STAGING_COLUMNS:
        if c == "event_date":
            cols.append(event_date("created_at").alias("event_date"))
        elif c == "event_type":
            cols.append(F.trim(F.col(c)).alias(c))
        elif c in STAGING_TEXT_COLUMNS:
            cols.append(clean_text(c).alias(c))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)


def stg_actors(raw: DataFrame, key: str = "actor_id", ts_col: str = "created_at",
               tie: str = "event_id") -> DataFrame:
    """One row per actor: trimmed login / display login as of the latest event."""
    src = D.drop_null_keys(raw, [key]).select(
        key, F.trim("actor_login").alias("actor_login"),
        F.trim("actor_display_login").alias("actor_display_login"), ts_col, tie)
    return D.latest_per_key(src, [key], [ts_col, tie]).select(key, "actor_login", "actor_display_login")


def stg_repos(raw: DataFrame, key: str = "repo_id", name_col: str = "repo_name",
              ts_col: str = "created_at", tie: str = "event_id", sep: str = "/") -> DataFrame:
    """One row per repo: latest name, split into owner and short name."""
    src = D.drop_null_keys(raw, [key]).select(key, F.trim(name_col).alias(name_col), ts_col, tie)
    latest = D.latest_per_key(src, [key], [ts_col, tie])
    return latest.select(key, name_col,
                         split_part(name_col, sep, 1).alias("repo_owner"),
                         split_part(name_col, sep, 2).alias("repo_short_name"))


# ----------------------------------------------- states of the intermediate models
def activity_measures() -> dict:
    """Per (date, repo, actor): what daily activity adds up from. Exact distinct actors of a
    (repo, date) are its rows with an actor."""
    counts = {"total_events": (F.count(F.lit(1)), "sum")}
    return counts | {name: (F.count_if(F.col("event_type") == F.lit(kind)), "sum") for name, kind in REPO_ACTIVITY_TYPES}


ACTIVITY_KEYS = ["event_date", "repo_id", "actor_id"]


def daily_of_activity(activity: DataFrame) -> DataFrame:
    """``int_daily_repo_activity`` from the activity state."""
    src = D.drop_null_keys(activity, ["repo_id"])
    sums = [F.sum(name).cast("long").alias(name) for name, _ in REPO_ACTIVITY_TYPES]
    out = src.groupBy("repo_id", "event_date").agg(
        F.sum("total_events").cast("long").alias("total_events"), F.count("actor_id").alias("distinct_actors"), *sums)
    return out.select(surrogate_key("repo_id", "event_date").alias("daily_repo_activity_id"), "repo_id", "event_date",
                      "total_events", "distinct_actors", *[name for name, _ in REPO_ACTIVITY_TYPES])


def seen_measures() -> dict:
    """Per actor: ``int_actor_first_last_seen`` itself merges."""
    return {"first_seen_at": (F.min("created_at"), "min"), "last_seen_at": (F.max("created_at"), "max"),
            "first_seen_date": (F.min("event_date"), "min"), "last_seen_date": (F.max("event_date"), "max"),
            "total_events": (F.count(F.lit(1)), "sum")}


def latest_measures(columns: Sequence[str], order_by: Sequence[str] = ("created_at", "event_id")) -> dict:
    """Per key: the columns as of the latest row, as the greatest (order, columns)."""
    ranked = [x for c in order_by for x in (F.col(c).isNotNull().alias(f"has_{c}"), F.col(c))]
    return {"latest": (F.max(F.struct(*ranked, *[F.trim(F.col(c)).alias(c) for c in columns])), "max")}


def actors_of_latest(latest: DataFrame) -> DataFrame:
    """``stg_actors`` from the state of latest rows."""
    return latest.select("actor_id", "latest.actor_login", "latest.actor_display_login")


def repos_of_latest(latest: DataFrame, sep: str = "/") -> DataFrame:
    """``stg_repos`` from the state of latest rows."""
    named = latest.select("repo_id", "latest.repo_name")
    return named.select("repo_id", "repo_name", split_part("repo_name", sep, 1).alias("repo_owner"),
                        split_part("repo_name", sep, 2).alias("repo_short_name"))


# -------------------------------------------------------------- intermediate
def _deduped(stg: DataFrame, dedupe: bool) -> DataFrame:
    """Staging may hold repeated event ids (only the fact enforces the grain);
    with ``dedupe`` the aggregates count each event once."""
    return D.first_per_key(stg, ["event_id"], ["created_at"]) if dedupe else stg


def int_daily_repo_activity(stg: DataFrame, dedupe: bool = False) -> DataFrame:
    stg = _deduped(stg, dedupe)
    return A.daily_activity(stg, key="repo_id", ts_col="created_at", type_col="event_type",
                            type_counts=REPO_ACTIVITY_TYPES, distinct_col="actor_id",
                            distinct_name="distinct_actors", id_name="daily_repo_activity_id")


def int_actor_first_last_seen(stg: DataFrame, dedupe: bool = False) -> DataFrame:
    stg = _deduped(stg, dedupe)
    return A.first_last_seen(stg, "actor_id", "created_at", date_col="event_date")


# ---------------------------------------------------------------------- marts
def fct_events(stg: DataFrame, mark=None, key: str = "event_id", date_col: str = "event_date",
               order_by: Sequence[str] = ("created_at",), lookback_days: int = 0) -> DataFrame:
    """One row per event id on every build path: rows after the mark (all when
    the mark is null), then the first row per key."""
    fresh = I.after_mark(stg, date_col, mark, lookback_days)
    # a hash of the whole row breaks ties on the ordering deterministically;
    # the flags tell rows apart that differ in which column is null
    rest = [x for c in stg.columns if c != key for x in (F.col(c).isNull(), F.col(c))]
    tagged = fresh.withColumn("_tie", F.xxhash64(*rest))
    return D.first_per_key(tagged, [key], [*order_by, "_tie"]).drop("_tie")


def dim_actors(summary: DataFrame, attributes: DataFrame, key: str = "actor_id") -> DataFrame:
    """Inner join of the per-key activity summary with current attributes.

    Both inputs are aggregates hash-partitioned on ``key`` by their own
    shuffle, so the join adds no exchange of its own.
    """
    return attributes.join(summary, key, "inner")


def dim_rollup(daily: DataFrame, dim: DataFrame, daily_key: str, dim_key: str,
               dim_cols: Sequence[str], date_col: str, count_col: str,
               first_name: str = "first_seen_date", last_name: str = "last_seen_date",
               total_name: str = "total_events") -> DataFrame:
    """Roll a (key, date) activity grain up to the key, then join the dimension
    (one row per key): only the key is grouped on and shuffled, and the join
    sees a row per key instead of a row per key and date."""
    rolled = A.rollup_span(daily, [daily_key], date_col, count_col, first_name, last_name, total_name)
    joined = rolled.withColumnRenamed(daily_key, dim_key).join(dim.select(dim_key, *dim_cols), dim_key)
    return joined.select(dim_key, *dim_cols, first_name, last_name, total_name)


def dim_actors_model(int_actor: DataFrame, actors: DataFrame, mark=None) -> DataFrame:
    s = I.after_mark(int_actor, "last_seen_date", mark)
    return dim_actors(s, actors, "actor_id").select(
        "actor_id", "actor_login", "actor_display_login", "first_seen_at", "last_seen_at",
        "first_seen_date", "last_seen_date", "total_events")


def dim_repos_model(daily: DataFrame, repos: DataFrame, mark=None) -> DataFrame:
    rolled = dim_rollup(daily, repos, "repo_id", "repo_id",
                        ["repo_name", "repo_owner", "repo_short_name"], "event_date", "total_events")
    out = rolled.select(F.col("repo_id"), "repo_name", "repo_owner", "repo_short_name",
                        "first_seen_date", "last_seen_date", "total_events")
    return I.groups_after_mark(out, "last_seen_date", mark)
