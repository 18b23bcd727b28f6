import datetime as dt

from pyspark.sql import functions as F

from pulse.operators import dims, history
from pulse.functions.scalars import CORE_DAYS, CORE_REPOS, NEW_DAYS

STG_REPOS = ("repo_id bigint, repo_full_name string, repo_description string, primary_language string, "
             "stargazers_count bigint, is_archived boolean, repo_created_at timestamp, "
             "repo_pushed_at timestamp, ingested_at timestamp")
FCT = ("event_id string, event_type string, event_at timestamp, event_date date, actor_id bigint, "
       "actor_login string, repo_id bigint, repo_full_name string, org_id bigint, org_login string, "
       "is_public boolean")


def T(s):
    return dt.datetime.fromisoformat(s)


def dim(spark, repos):
    """repos: (repo_id, language, stars) -> one-snapshot dim_repos."""
    rows = [(rid, f"o/r{rid}", None, lang, stars, False, T("2020-01-01 00:00:00"), None,
             T("2024-01-01 00:00:00")) for rid, lang, stars in repos]
    return dims.dim_repos(spark.createDataFrame(rows, STG_REPOS))


def fct(spark, events):
    """events: (event_id, type, 'YYYY-MM-DD HH:MM:SS', actor, repo)."""
    rows = []
    for eid, typ, at, actor, repo in events:
        t = T(at)
        rows.append((str(eid), typ, t, t.date(), actor, f"u{actor}", repo, f"o/r{repo}", None, None, True))
    return spark.createDataFrame(rows, FCT)


def contributor_tiers_direct(stg_users, fct, new_days: int = NEW_DAYS,
                             core_repos: int = CORE_REPOS, core_days: int = CORE_DAYS):
    """The literal form: left join every event at or before each snapshot, then
    aggregate. Its join output grows as events x snapshots; kept only to check
    the rewritten form on small inputs."""
    s = history.user_snapshot_times(stg_users).alias("s")
    e = fct.select("actor_id", "repo_id", "event_at").alias("e")
    joined = s.join(e, (F.col("e.actor_id") == F.col("s.user_id"))
                    & (F.col("e.event_at") <= F.col("s.snapshot_at")), "left")
    agg = joined.groupBy("s.user_id", "s.snapshot_at", "s.snapshot_date").agg(
        F.min("e.event_at").alias("first_event_at"),
        F.count_distinct("e.repo_id").alias("distinct_repos"))
    return history._tier_columns(agg, new_days, core_repos, core_days)
