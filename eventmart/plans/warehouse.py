"""Build the star schema from the warehouse raw table, run its data tests,
and take the SCD-2 snapshot -- the model build of one day.

Staging models are views (named temp views, nothing stored). The intermediate
aggregates and the per-key attributes are views of mergeable states: a build that
is told what rows are new (``delta``) merges only these, a build without rebuilds
them. The fact and the two dimensions are incremental tables merged on their keys;
the data tests run after the models and an ``error`` failure stops the build
(``warn`` is reported).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import quality as Q
from eventmart.operators import scd2
from eventmart.operators.dedup import drop_null_keys
from eventmart.operators.state import MergedState
from eventmart.plans import models as M
from eventmart.plans.materialize import materialize_incremental, materialize_view
from eventmart.schema import KNOWN_EVENT_TYPES
from eventmart.session import run_together
from eventmart.sinks.table import VersionedTable


@dataclass
class Warehouse:
    """``fact_buckets``: buckets of the fact in each date; about the bytes of a date / 128 MB."""
    root: str
    fact_buckets: int = 2

    def table(self, spark: SparkSession, name: str, partition_by: str | None = None,
              bucket_by: tuple[list[str], int] | None = None) -> VersionedTable:
        return VersionedTable(spark, f"{self.root.rstrip('/')}/{name}", partition_by=partition_by, bucket_by=bucket_by)

    def mart(self, spark: SparkSession, name: str) -> VersionedTable:
        if name == "fct_events":
            return self.table(spark, name, "event_date", (["event_id"], self.fact_buckets))
        return self.table(spark, name)


def model_tests(models: Mapping[str, DataFrame]) -> dict[str, list]:
    """The declared tests per model. Which column is tested how,
    and the one ``warn`` (staging event ids may repeat upstream)."""
    def references(column: str, parent: str):
        return Q.relationships(column, models[parent], column)

    return {
        "stg_events": [Q.not_null("event_id"), Q.unique("event_id", severity=Q.WARN), Q.not_null("event_type"),
                       Q.accepted_values("event_type", sorted(KNOWN_EVENT_TYPES)), Q.not_null("created_at")],
        "stg_actors": [Q.not_null("actor_id"), Q.unique("actor_id")],
        "stg_repos": [Q.not_null("repo_id"), Q.unique("repo_id")],
        "int_daily_repo_activity": [Q.not_null("daily_repo_activity_id"), Q.unique("daily_repo_activity_id"),
                                    Q.not_null("repo_id"), references("repo_id", "stg_repos")],
        "int_actor_first_last_seen": [Q.not_null("actor_id"), Q.unique("actor_id"), references("actor_id", "stg_actors")],
        "fct_events": [Q.not_null("event_id"), Q.unique("event_id"), references("repo_id", "dim_repos"),
                       references("actor_id", "dim_actors")],
        "dim_repos": [Q.not_null("repo_id"), Q.unique("repo_id")],
        "dim_actors": [Q.not_null("actor_id"), Q.unique("actor_id")],
    }


class ModelStates:
    """The states behind the intermediate models and the attributes, under the warehouse's root."""

    def __init__(self, spark: SparkSession, wh: Warehouse):
        def state(name, keys, measures, partition_by=None):
            return MergedState(wh.table(spark, f"state_{name}", partition_by), keys, measures)

        self.spark = spark
        self.activity = state("activity", M.ACTIVITY_KEYS, M.activity_measures(), "event_date")
        self.seen = state("actor_seen", ["actor_id"], M.seen_measures())
        self.actors = state("actor_latest", ["actor_id"], M.latest_measures(["actor_login", "actor_display_login"]))
        self.repos = state("repo_latest", ["repo_id"], M.latest_measures(["repo_name"]))

    def load(self, raw: DataFrame, delta: DataFrame | None, marts: Collection[str], source: VersionedTable | None = None, **tag) -> None:
        """What the marts need: follow the source, merge the delta, or rebuild from raw."""
        def staged(key):
            return lambda rows: drop_null_keys(M.stg_events(rows), [key]) if key else M.stg_events(rows)

        def keyed(key):
            return lambda rows: drop_null_keys(rows, [key])

        needed = []
        if "dim_actors" in marts:
            needed += [(self.seen, staged("actor_id")), (self.actors, keyed("actor_id"))]
        if "dim_repos" in marts:
            needed += [(self.activity, staged(None)), (self.repos, keyed("repo_id"))]

        def load_one(state: MergedState, of) -> None:
            if source is not None:
                state.follow(VersionedTable(self.spark, source.root), of)
            elif delta is not None:
                state.update(of(delta), **tag)
            else:
                state.rebuild(of(raw), **tag)

        run_together(self.spark, [partial(load_one, state, of) for state, of in needed])

    def models(self) -> dict[str, DataFrame]:
        return {"stg_actors": M.actors_of_latest(self.actors.read()), "stg_repos": M.repos_of_latest(self.repos.read()),
                "int_daily_repo_activity": M.daily_of_activity(self.activity.read()), "int_actor_first_last_seen": self.seen.read()}


MARTS = ("fct_events", "dim_actors", "dim_repos")


def build_models(spark: SparkSession, raw: DataFrame, wh: Warehouse, run_tests: bool = True, delta: DataFrame | None = None,
                 marts: Collection[str] = MARTS, source: VersionedTable | None = None, **tag) -> dict:
    """Staging -> intermediate -> marts (incremental), then tests; returns the
    mart versions written and the warnings.

    ``delta``: exactly the rows of ``raw`` that the build before did not have, with an
    optional tag (``query_id``, ``batch_id``) that makes merging them idempotent.
    ``source``: the table that ``raw`` is a load of; the states follow its commits.
    ``marts``: build only these, and what they read.
    """
    stg = materialize_view(M.stg_events(raw), "stg_events")
    states = ModelStates(spark, wh)
    states.load(raw, delta, marts, source, **tag)
    views: dict[str, DataFrame] = {}
    if set(marts) >= {"dim_actors", "dim_repos"}:
        views = {name: materialize_view(df, name) for name, df in states.models().items()}

    tables = {name: wh.mart(spark, name) for name in MARTS}
    builds = {}
    if "fct_events" in marts:
        builds["fct_events"] = (lambda mark: M.fct_events(stg, mark), ["event_id"], "event_date")
    if "dim_actors" in marts:
        seen, actors = states.seen.read(), M.actors_of_latest(states.actors.read())
        builds["dim_actors"] = (lambda mark: M.dim_actors_model(seen, actors, mark), ["actor_id"], "last_seen_date")
    if "dim_repos" in marts:
        daily, repos = M.daily_of_activity(states.activity.read()), M.repos_of_latest(states.repos.read())
        builds["dim_repos"] = (lambda mark: M.dim_repos_model(daily, repos, mark), ["repo_id"], "last_seen_date")
    written = run_together(spark, [partial(materialize_incremental, build, tables[name], keys, mark_col)
                                   for name, (build, keys, mark_col) in builds.items()])
    versions = dict(zip(builds, written, strict=True))
    warnings: list = []
    if run_tests:
        warnings = Q.gate(test_results(views | {"stg_events": stg} | {name: t.read() for name, t in tables.items()}))
    return {"versions": versions, "warnings": warnings}


def test_results(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, test, col, severity, failures) of every declared test, in one job."""
    out = None
    for name, tests in model_tests(models).items():
        part = Q.run_tests(models[name], tests).select(F.lit(name).alias("model"), *Q.RESULT_COLUMNS)
        out = part if out is None else out.unionByName(part)
    return out


def snapshot_repos(spark: SparkSession, raw: DataFrame, wh: Warehouse, snapshot_ts) -> int:
    """SCD-2 history of repo identity (name, owner, short name), keyed on
    repo_id, compared on every run (check strategy)."""
    hist_t = wh.table(spark, "dim_repos_snapshot", scd2.IS_OPEN)
    return scd2.snapshot_table(hist_t, M.stg_repos(raw), "repo_id", ["repo_name", "repo_owner", "repo_short_name"], snapshot_ts)
