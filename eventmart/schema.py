"""Declared schemas: the raw event envelope, the flat table and its contract.

Schemas are always declared, never inferred: inference costs an extra pass
over the input and makes the output shape depend on what one sample held.
Every field is nullable; JSON fields not declared are dropped by the reader,
declared fields missing from a line come back null.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values. Everything from here to the end of the block must equal the
# reference for right results: field names and types of the public
# code-hosting event archive format, the event types the flat table was
# checked against, the flat column names, the warehouse contract and the
# staging column list.
# ---------------------------------------------------------------------------

EVENT_DDL = (
    "id STRING, type STRING, "
    "actor STRUCT<id: BIGINT, login: STRING, display_login: STRING, url: STRING, avatar_url: STRING>, "
    "repo STRUCT<id: BIGINT, name: STRING, url: STRING>, "
    "org STRUCT<id: BIGINT, login: STRING, url: STRING>, "
    "payload STRUCT<action: STRING, ref: STRING, ref_type: STRING, push_id: BIGINT, size: INT, "
    "distinct_size: INT, head: STRING, before: STRING, number: INT, "
    "pull_request: STRUCT<id: BIGINT, state: STRING, merged: BOOLEAN, created_at: TIMESTAMP, merged_at: TIMESTAMP>, "
    "issue: STRUCT<id: BIGINT, number: INT, state: STRING>, "
    "comment: STRUCT<id: BIGINT>, "
    "forkee: STRUCT<id: BIGINT, full_name: STRING>, "
    "release: STRUCT<id: BIGINT, tag_name: STRING>, "
    "member: STRUCT<id: BIGINT, login: STRING>>, "
    "public BOOLEAN, created_at TIMESTAMP"
)

KNOWN_EVENT_TYPES = frozenset({
    "CommitCommentEvent", "CreateEvent", "DeleteEvent", "ForkEvent", "GollumEvent",
    "IssueCommentEvent", "IssuesEvent", "MemberEvent", "PublicEvent", "PullRequestEvent",
    "PullRequestReviewCommentEvent", "PullRequestReviewEvent", "PushEvent", "ReleaseEvent",
    "WatchEvent",
})

# (nested source path, flat column name); the date partition column is derived
# from created_at by ``flatten`` and placed right after it.
EVENT_FLAT_FIELDS = [
    ("id", "event_id"), ("type", "event_type"), ("created_at", "created_at"),
    ("public", "is_public"),
    ("actor.id", "actor_id"), ("actor.login", "actor_login"),
    ("actor.display_login", "actor_display_login"),
    ("repo.id", "repo_id"), ("repo.name", "repo_name"),
    ("org.id", "org_id"), ("org.login", "org_login"),
    ("payload.action", "action"), ("payload.ref", "ref"), ("payload.ref_type", "ref_type"),
    ("payload.push_id", "push_id"), ("payload.size", "push_size"),
    ("payload.distinct_size", "push_distinct_size"), ("payload.head", "push_head"),
    ("payload.before", "push_before"), ("payload.number", "pr_number"),
    ("payload.pull_request.id", "pr_id"), ("payload.pull_request.state", "pr_state"),
    ("payload.pull_request.merged", "pr_merged"),
    ("payload.pull_request.created_at", "pr_created_at"),
    ("payload.pull_request.merged_at", "pr_merged_at"),
    ("payload.issue.id", "issue_id"), ("payload.issue.number", "issue_number"),
    ("payload.issue.state", "issue_state"), ("payload.comment.id", "comment_id"),
    ("payload.forkee.id", "forkee_id"), ("payload.forkee.full_name", "forkee_full_name"),
    ("payload.release.id", "release_id"), ("payload.release.tag_name", "release_tag"),
    ("payload.member.id", "member_id"), ("payload.member.login", "member_login"),
]

# Warehouse raw-table contract of the flat table (36 columns, in order).
EVENTS_CONTRACT_DDL = (
    "event_id STRING, event_type STRING, created_at TIMESTAMP, event_date DATE, is_public BOOLEAN, "
    "actor_id BIGINT, actor_login STRING, actor_display_login STRING, repo_id BIGINT, repo_name STRING, "
    "org_id BIGINT, org_login STRING, action STRING, ref STRING, ref_type STRING, push_id BIGINT, "
    "push_size INT, push_distinct_size INT, push_head STRING, push_before STRING, pr_number INT, "
    "pr_id BIGINT, pr_state STRING, pr_merged BOOLEAN, pr_created_at TIMESTAMP, pr_merged_at TIMESTAMP, "
    "issue_id BIGINT, issue_number INT, issue_state STRING, comment_id BIGINT, forkee_id BIGINT, "
    "forkee_full_name STRING, release_id BIGINT, release_tag STRING, member_id BIGINT, member_login STRING"
)

# Staging keeps these 27 columns (descriptive names/heads/tags go to dims).
STAGING_COLUMNS = [
    "event_id", "event_type", "created_at", "event_date", "is_public", "actor_id", "repo_id",
    "org_id", "action", "ref", "ref_type", "push_id", "push_size", "push_distinct_size",
    "pr_number", "pr_id", "pr_state", "pr_merged", "pr_created_at", "pr_merged_at", "issue_id",
    "issue_number", "issue_state", "comment_id", "forkee_id", "release_id", "member_id",
]
# Of those, the free-text ones are trimmed and blank becomes null.
STAGING_TEXT_COLUMNS = ["event_type", "action", "ref", "ref_type", "pr_state", "issue_state"]

# ------------------------------------------------------- end of fixed values

CORRUPT_COLUMN = "_corrupt_record"


def event_schema() -> StructType:
    return StructType.fromDDL(EVENT_DDL)


def events_contract() -> StructType:
    return StructType.fromDDL(EVENTS_CONTRACT_DDL)


def with_corrupt_column(schema: StructType, name: str = CORRUPT_COLUMN) -> StructType:
    """A new schema with a trailing string column for unparseable lines.

    Builds a new object: ``StructType.add`` mutates in place and would leak the
    extra column into every other user of the shared schema.
    """
    return StructType(list(schema.fields) + [StructField(name, StringType(), True)])
