"""Staging: rename, cast, dedup; no joins (M4, M5, M6)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.streaming import windows

#: Days staged by a full build.
FULL_LOOKBACK_DAYS = windows.STAGING_WINDOW_DAYS

EVENT_COLUMNS = ("event_id", "event_type", "event_at", "event_date", "actor_id", "actor_login",
                 "repo_id", "repo_full_name", "org_id", "org_login", "is_public")


def stage_event_days(raw: DataFrame, days: list[date], around: int = windows.LOOKBACK_DAYS,
                     day_col: str = "dt") -> DataFrame:
    """The staged events of ``days`` only: their day tables and those up to ``around`` days from them are read
    (partition pruning by a list), so that ids are deduplicated against neighbouring days as a full
    build does; copies of one id that are further apart are not seen together."""
    near = sorted({d + timedelta(days=k) for d in days for k in range(-around, around + 1)})
    near_days = [F.lit(d) for d in near]
    src = raw.filter(F.col(day_col).isin(near_days)).filter(F.to_date("created_at").isin(near_days))
    rows = stage_events(src, near[-1], (near[-1] - near[0]).days, day_col)
    return rows.filter(F.col("event_date").isin([F.lit(d) for d in sorted(days)]))


def outdated_days(stored: DataFrame, rows: DataFrame, days: list[date], around: int = windows.LOOKBACK_DAYS) -> list[date]:
    """Neighbouring stored days that hold a copy of an id which is now among the ``rows`` of ``days``: its earliest copy
    has come, so theirs has to go. At most ``2 * around`` days a day."""
    near = {d + timedelta(days=k) for d in days for k in range(-around, around + 1)} - set(days)
    if not near:
        return []
    held = stored.filter(F.col("event_date").isin([F.lit(d) for d in sorted(near)])).select("event_date", "event_id")
    found = held.join(rows.select("event_id"), "event_id", "left_semi").select("event_date").distinct()
    return sorted(r.event_date for r in found.collect())


def stage_events(raw: DataFrame, as_of: date, lookback_days: int = FULL_LOOKBACK_DAYS,
                 day_col: str = "dt") -> DataFrame:
    """Recent raw events -> one row per event id, 11 renamed columns.

    The day filter is on the day-table column ``day_col``, so a day-partitioned
    source prunes whole directories (``PartitionFilters``); a source without it
    raises, since every day would be scanned.
    Only the struct subfields used are selected, so Parquet reads
    ``actor.id``/``actor.login``, not the whole structs. Duplicate ids keep the
    earliest copy; the remaining columns break ties so the pick is stable.
    Rows dated before the cutoff are dropped too, so a day partition written
    from this result always holds the whole day.
    """
    cutoff = F.date_sub(F.lit(as_of), lookback_days)
    if day_col not in raw.columns:
        raise ValueError(f"raw events need the day column {day_col!r}: without it the whole source is scanned")
    src = raw.filter(F.col(day_col) >= cutoff).select(
        F.col("id"), F.col("type"), F.col("created_at"),
        F.col("actor.id").alias("actor_id"), F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_full_name"),
        F.col("org.id").alias("org_id"), F.col("org.login").alias("org_login"),
        F.col("public"),
    ).filter(F.to_date("created_at") >= cutoff)
    first_copy = Window.partitionBy("id").orderBy(
        "created_at", "type", "actor_id", "actor_login", "repo_id", "repo_full_name",
        "org_id", "org_login", "public")
    deduped = src.withColumn("_copy", F.row_number().over(first_copy)).filter("_copy = 1")
    return deduped.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("created_at").cast("timestamp").alias("event_at"),
        F.to_date("created_at").alias("event_date"),
        "actor_id", "actor_login", "repo_id", "repo_full_name", "org_id", "org_login",
        F.col("public").alias("is_public"),
    )


def stage_repos(raw: DataFrame) -> DataFrame:
    """Raw repo snapshots -> staging names; every snapshot is kept."""
    return raw.select(
        F.col("id").alias("repo_id"),
        F.col("node_id").alias("repo_node_id"),
        F.col("name").alias("repo_name"),
        F.col("full_name").alias("repo_full_name"),
        "owner_id", "owner_login",
        F.col("description").alias("repo_description"),
        F.col("fork").alias("is_fork"),
        F.col("language").alias("primary_language"),
        "stargazers_count", "watchers_count", "forks_count", "open_issues_count",
        F.col("archived").alias("is_archived"),
        F.col("created_at").alias("repo_created_at"),
        F.col("pushed_at").alias("repo_pushed_at"),
        "ingested_at",
    )


def stage_users(raw: DataFrame) -> DataFrame:
    """Raw user snapshots -> staging names; every snapshot is kept."""
    return raw.select(
        F.col("id").alias("user_id"),
        F.col("node_id").alias("user_node_id"),
        F.col("login").alias("user_login"),
        F.col("type").alias("user_type"),
        F.col("site_admin").alias("is_site_admin"),
        F.col("name").alias("user_name"),
        F.col("company").alias("user_company"),
        F.col("location").alias("user_location"),
        "public_repos", "followers", "following",
        F.col("created_at").alias("user_created_at"),
        "ingested_at",
    )


def latest_snapshot(df: DataFrame, key: str | list[str], order_col: str = "ingested_at") -> DataFrame:
    """One current row per key: the row with the greatest ``order_col``; of several at
    that time, the one whose columns hash highest, so reruns agree.

    ``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit`` before
    the shuffle, so each map task forwards only its latest row per key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(order_col).desc(), F.xxhash64(*df.columns).desc())
    return (df.withColumn("_newest", F.row_number().over(newest_first))
            .filter("_newest = 1").drop("_newest"))
