"""The declared checks of every model: one list for the jobs and the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame

from pulse import schemas
from pulse.operators import checks
from pulse.operators.checks import Check
from pulse.streaming import windows

#: Columns that may not be null, by model.
NOT_NULL = {
    "raw_repos": ("id",),
    "raw_users": ("id",),
    "stg_events": ("event_id", "event_type", "event_at", "event_date"),
    "stg_repos": ("repo_id", "repo_full_name", "owner_id", "is_fork", "is_archived", "repo_created_at", "ingested_at"),
    "stg_users": ("user_id", "user_login", "user_type", "is_site_admin", "user_created_at", "ingested_at"),
    "fct_events": ("event_id", "event_type", "event_at", "event_date", "actor_id", "repo_id"),
    "dim_repos": ("dim_repo_id", "repo_id", "star_bucket", "is_archived", "valid_from", "is_current"),
    "dim_users": ("dim_user_id", "user_id", "contributor_tier", "valid_from", "is_current"),
    "dim_languages": ("dim_language_id", "language_name"),
    "dim_dates": ("date_day",),
    "contributor_tiers": ("user_id", "snapshot_at", "contributor_tier"),
    "repo_health": ("repo_id", "repo_full_name", "bus_factor_label"),
    "language_trends": ("language", "new_contributors"),
    "pr_velocity": ("actor_id", "days_to_second_pr"),
}
#: Column sets that identify a row, by model. Event ids are checked over the last days only.
UNIQUE = {
    "stg_repos": (("repo_id", "ingested_at"),),
    "stg_users": (("user_id", "ingested_at"),),
    "dim_repos": (("dim_repo_id",), ("repo_id", "valid_from")),
    "dim_users": (("dim_user_id",), ("user_id", "valid_from")),
    "dim_languages": (("dim_language_id",), ("language_name",)),
    "dim_dates": (("date_day",),),
    "contributor_tiers": (("user_id", "snapshot_at"),),
    "repo_health": (("repo_id",),),
    "language_trends": (("language", "week_start"),),
    "pr_velocity": (("actor_id",),),
}
#: Columns with a closed set of values, by model: (column, values, severity).
ACCEPTED = {
    "stg_events": ("event_type", schemas.EVENT_TYPES, "warn"),
    "fct_events": ("event_type", schemas.EVENT_TYPES, "warn"),
    "stg_users": ("user_type", schemas.USER_TYPES, "error"),
    "dim_repos": ("star_bucket", schemas.STAR_BUCKETS, "error"),
    "contributor_tiers": ("contributor_tier", schemas.TIERS, "error"),
    "repo_health": ("bus_factor_label", schemas.BUS_FACTOR_LABELS, "error"),
}
#: dim_users has two closed columns.
ACCEPTED_USERS = (("user_type", schemas.USER_TYPES), ("contributor_tier", schemas.TIERS))


def declared(model: str, as_of: date, now: datetime,
             users: Callable[[], DataFrame] | None = None) -> list[Check]:
    """The checks of one model. ``users``: staged users, for references to them."""
    out = [Check(f"{model}_{c}_not_null", model, bad=checks.null_in(c)) for c in NOT_NULL[model]]
    for cols in UNIQUE.get(model, ()):
        out.append(Check(f"{model}_{'_'.join(cols)}_unique", model, lambda d, cols=cols: checks.unique(d, *cols)))
    if model in ACCEPTED:
        column, values, severity = ACCEPTED[model]
        out.append(Check(f"{model}_{column}_accepted", model, severity=severity, bad=checks.outside(column, values)))
    if model == "dim_users":
        out += [Check(f"{model}_{c}_accepted", model, bad=checks.outside(c, values)) for c, values in ACCEPTED_USERS]
    if model in ("stg_events", "fct_events"):
        recent = f"event_date >= date_sub(date'{as_of.isoformat()}', {windows.UNIQUE_CHECK_DAYS})"
        out.append(Check(f"{model}_event_id_unique_7d", model, lambda d: checks.unique(d, "event_id"), where=recent))
    if model == "stg_events":
        out.append(Check("no_future_events", model, bad=checks.after("event_at", now), keep=("event_id", "event_at")))
    if model == "fct_events":
        out.append(Check("fct_recency_48h", model, lambda d: checks.recency(d, "event_at", now, 48), "warn", newest=True))
    if model == "stg_repos" and users is not None:
        out.append(Check("repo_owner_is_user", model, lambda d: checks.relationships(
            d, "owner_id", users(), "user_id").select("repo_id", "owner_id", "ingested_at")))
    if model == "stg_users":
        out.append(Check("orgs_dont_follow", model, bad=checks.org_follows(), keep=("user_id", "user_login", "following")))
    if model in ("dim_repos", "dim_users"):
        key = "repo_id" if model == "dim_repos" else "user_id"
        out.append(Check(f"{model}_no_overlap", model,
                         lambda d: checks.no_overlap(d, model, key, f"dim_{key}")))
    return out


MODELS = tuple(NOT_NULL)
