"""Marts (M16-M18) and the dashboard rollups over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions import bus_factor_label, safe_ratio, week_start, whole_hour_days

# Mart window (days) and the dashboard histogram bin width (days).
MART_DAYS = 90
HISTOGRAM_BIN_DAYS = 1.0
MEDIAN_DIGITS = 4
PR_EVENT = "PullRequestEvent"


def _window(fct: DataFrame, as_of: date, days: int) -> DataFrame:
    return fct.filter(F.col("event_date") >= F.date_sub(F.lit(as_of), days))


def _tracked_ids(dim_repos_df: DataFrame) -> DataFrame:
    """Repo ids of *any* version: the tracked set the marts filter on."""
    return dim_repos_df.select("repo_id").distinct()


def repo_health(dim_repos_df: DataFrame, fct: DataFrame, as_of: date, days: int = MART_DAYS) -> DataFrame:
    """One row per current repo: activity, contributors, top-contributor share,
    bus-factor label and age. ``fct`` is the fact or its daily partials (``partials.day_activity``).

    Both aggregates are partial (map-side) aggregations, so a repo or an actor
    holding a third of the events is reduced to one row per task before any
    shuffle. Contributors are a plain count: rows are already one per (repo, actor).
    """
    repos = dim_repos_df.filter("is_current").select(
        "repo_id", "repo_full_name", "primary_language", "star_bucket", "stargazers_count",
        "is_archived", "repo_created_at")
    events = F.sum("n_events") if "n_events" in fct.columns else F.count(F.lit(1))
    shares = (_window(fct, as_of, days).join(_tracked_ids(dim_repos_df), "repo_id", "left_semi")
              .groupBy("repo_id", "actor_id").agg(events.alias("n")))
    activity = shares.groupBy("repo_id").agg(
        F.sum("n").alias("events_90d"), F.count("actor_id").alias("contributors_90d"),
        F.max("n").alias("most_by_one"))
    j = repos.join(activity, "repo_id", "left")
    return j.select(
        "repo_id", "repo_full_name", "primary_language", "star_bucket", "stargazers_count",
        "is_archived",
        F.datediff(F.lit(as_of), F.to_date("repo_created_at")).alias("repo_age_days"),
        F.coalesce(F.col("events_90d"), F.lit(0)).cast("bigint").alias("events_90d"),
        F.coalesce(F.col("contributors_90d"), F.lit(0)).cast("bigint").alias("contributors_90d"),
        F.round(safe_ratio("most_by_one", "events_90d"), 3).alias("top_contributor_share"),
        bus_factor_label("events_90d", "most_by_one").alias("bus_factor_label"),
    )


def language_trends(dim_repos_df: DataFrame, fct: DataFrame, as_of: date, days: int = MART_DAYS,
                    first_day: str = "SUN") -> DataFrame:
    """New contributors per (language, week): an actor is new to a language in
    the week of their first event on a current repo of that language. ``fct`` is the fact or its daily
    partials (``partials.day_activity``).

    Events meet the current repos with a language first, so only tracked repos' events
    are grouped; ``min`` combines before the shuffle, so a hot actor or repo sends one
    row per language from each task.
    """
    current = (dim_repos_df.filter(F.col("is_current") & F.col("primary_language").isNotNull())
               .select("repo_id", "primary_language"))
    first_seen = (_window(fct, as_of, days).join(current, "repo_id")
                  .groupBy("actor_id", "primary_language").agg(F.min("event_date").alias("first_event_date")))
    return (first_seen.groupBy(F.col("primary_language").alias("language"),
                               week_start("first_event_date", first_day).alias("week_start"))
            .agg(F.count(F.lit(1)).alias("new_contributors")))


def pr_velocity(dim_repos_df: DataFrame, fct: DataFrame, as_of: date, days: int = MART_DAYS) -> DataFrame:
    """Per actor with two or more PR events on tracked repos: the first two PR
    times and the whole hours between them in days. ``fct`` is the fact or its first PRs by the day
    (``partials.day_prs``).

    Keeping ranks up to 2 makes Spark add a partial ``WindowGroupLimit`` before the
    shuffle, so a bot with millions of PR events sends two rows per task; the time after
    the first is then the next row of the same window.
    """
    recent = _window(fct, as_of, days)
    if "event_type" in fct.columns:
        recent = recent.filter(F.col("event_type") == PR_EVENT)
    opened = (recent
              .join(_tracked_ids(dim_repos_df), "repo_id", "left_semi").select("actor_id", "event_at"))
    by_time = Window.partitionBy("actor_id").orderBy("event_at")
    starts = (opened.withColumn("place", F.row_number().over(by_time)).filter("place <= 2")
              .withColumn("then", F.lead("event_at").over(by_time))
              .filter((F.col("place") == 1) & F.col("then").isNotNull()))
    return starts.select(
        "actor_id", F.col("event_at").alias("first_pr_at"), F.col("then").alias("second_pr_at"),
        whole_hour_days("event_at", "then").alias("days_to_second_pr"))


# --- dashboard rollups (M19) -------------------------------------------------

def panel_trends(trends: DataFrame) -> DataFrame:
    """New contributors summed by (week, language)."""
    return (trends.groupBy("week_start", "language")
            .agg(F.sum("new_contributors").cast("bigint").alias("new_contributors")))


def panel_velocity_median(velocity: DataFrame, digits: int = MEDIAN_DIGITS) -> DataFrame:
    """Exact median of days to the second PR (not an approximate percentile).

    The exact percentile keeps a (value -> count) map per partial aggregate.
    Values are whole hours / 24 within the mart window, so the map holds at most
    24 x window-days + 1 entries however many actors there are.
    """
    return velocity.agg(
        F.round(F.median("days_to_second_pr"), digits).alias("median_days"),
        F.count(F.lit(1)).alias("actors"))


def panel_velocity_hist(velocity: DataFrame, bin_days: float = HISTOGRAM_BIN_DAYS) -> DataFrame:
    """Actors per bin of days to the second PR, bins ``[k*w, (k+1)*w)``."""
    bin_start = (F.floor(F.col("days_to_second_pr") / F.lit(bin_days)) * F.lit(bin_days))
    return (velocity.groupBy(bin_start.cast("double").alias("bin_start_days"))
            .agg(F.count(F.lit(1)).alias("actors")))


def panel_bus_factor(health: DataFrame) -> DataFrame:
    """Repos sorted by top-contributor share, highest first (repo id breaks ties)."""
    return (health.select("repo_id", "repo_full_name", "top_contributor_share", "bus_factor_label",
                          "events_90d", "contributors_90d")
            .orderBy(F.col("top_contributor_share").desc_nulls_last(), F.col("repo_id")))


def panel_characteristics(health: DataFrame) -> DataFrame:
    """Points for activity against repo characteristics (stars, age, language)."""
    return health.select("repo_id", "primary_language", "star_bucket", "stargazers_count",
                         "repo_age_days", "events_90d", "contributors_90d")
