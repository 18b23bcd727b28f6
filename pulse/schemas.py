"""Declared schemas of the raw inputs (fixed, as the reference declares them)."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw repo snapshot: 17 columns. Required: id, full_name, owner_id, ingested_at.
REPOS = StructType([
    StructField("id", LongType()),
    StructField("node_id", StringType()),
    StructField("name", StringType()),
    StructField("full_name", StringType()),
    StructField("owner_id", LongType()),
    StructField("owner_login", StringType()),
    StructField("description", StringType()),
    StructField("fork", BooleanType()),
    StructField("language", StringType()),
    StructField("stargazers_count", LongType()),
    StructField("watchers_count", LongType()),
    StructField("forks_count", LongType()),
    StructField("open_issues_count", LongType()),
    StructField("archived", BooleanType()),
    StructField("created_at", TimestampType()),
    StructField("pushed_at", TimestampType()),
    StructField("ingested_at", TimestampType()),
])
REPOS_REQUIRED = ("id", "full_name", "owner_id", "ingested_at")

# Raw user snapshot: 13 columns. Required: id, login, ingested_at.
USERS = StructType([
    StructField("id", LongType()),
    StructField("node_id", StringType()),
    StructField("login", StringType()),
    StructField("type", StringType()),
    StructField("site_admin", BooleanType()),
    StructField("name", StringType()),
    StructField("company", StringType()),
    StructField("location", StringType()),
    StructField("public_repos", LongType()),
    StructField("followers", LongType()),
    StructField("following", LongType()),
    StructField("created_at", TimestampType()),
    StructField("ingested_at", TimestampType()),
])
USERS_REQUIRED = ("id", "login", "ingested_at")

# Repo API document as it arrives (JSON): owner is nested, timestamps are text
# that may be "" and unknown keys are not declared, so the reader drops them.
REPO_DOCUMENT = StructType([
    StructField("id", LongType()),
    StructField("node_id", StringType()),
    StructField("name", StringType()),
    StructField("full_name", StringType()),
    StructField("owner", StructType([
        StructField("id", LongType()),
        StructField("login", StringType()),
    ])),
    StructField("description", StringType()),
    StructField("fork", BooleanType()),
    StructField("language", StringType()),
    StructField("stargazers_count", LongType()),
    StructField("watchers_count", LongType()),
    StructField("forks_count", LongType()),
    StructField("open_issues_count", LongType()),
    StructField("archived", BooleanType()),
    StructField("created_at", StringType()),
    StructField("pushed_at", StringType()),
])

USER_DOCUMENT = StructType([
    StructField("id", LongType()),
    StructField("node_id", StringType()),
    StructField("login", StringType()),
    StructField("type", StringType()),
    StructField("site_admin", BooleanType()),
    StructField("name", StringType()),
    StructField("company", StringType()),
    StructField("location", StringType()),
    StructField("public_repos", LongType()),
    StructField("followers", LongType()),
    StructField("following", LongType()),
    StructField("created_at", StringType()),
])

# Raw public event, only the fields staging reads (payload is never read).
EVENTS = StructType([
    StructField("id", StringType()),
    StructField("type", StringType()),
    StructField("created_at", TimestampType()),
    StructField("actor", StructType([
        StructField("id", LongType()),
        StructField("login", StringType()),
    ])),
    StructField("repo", StructType([
        StructField("id", LongType()),
        StructField("name", StringType()),
    ])),
    StructField("org", StructType([
        StructField("id", LongType()),
        StructField("login", StringType()),
    ])),
    StructField("public", BooleanType()),
])

# Stored events (staged and fact): 11 columns, partitioned by event_date.
STORED_EVENTS = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_at", TimestampType()),
    StructField("actor_id", LongType()),
    StructField("actor_login", StringType()),
    StructField("repo_id", LongType()),
    StructField("repo_full_name", StringType()),
    StructField("org_id", LongType()),
    StructField("org_login", StringType()),
    StructField("is_public", BooleanType()),
    StructField("event_date", DateType()),
])

# Accepted event types (16).
EVENT_TYPES = (
    "PushEvent", "PullRequestEvent", "IssuesEvent", "IssueCommentEvent",
    "PullRequestReviewEvent", "PullRequestReviewCommentEvent", "WatchEvent",
    "ForkEvent", "CreateEvent", "DeleteEvent", "ReleaseEvent", "PublicEvent",
    "MemberEvent", "GollumEvent", "CommitCommentEvent", "DiscussionEvent",
)
USER_TYPES = ("User", "Organization", "Bot")
TIERS = ("new", "regular", "core")
STAR_BUCKETS = ("small", "medium", "large")
BUS_FACTOR_LABELS = ("bus_factor_1", "bus_factor_low", "healthy_pyramid", "inactive")
