"""Dimensions: repos and users as Type 2 (M12, M13), languages and calendar as
Type 1 (M14, M15)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions import star_bucket, surrogate_key, week_start
from pulse.functions.scalars import LARGE_STARS, SMALL_STARS
from pulse.operators import history
from pulse.operators.history import scd2

# Calendar range of the date dimension.
CALENDAR_START = date(2024, 1, 1)
CALENDAR_END = date(2027, 12, 31)
CALENDAR_MARGIN_YEARS = 3

REPO_COLUMNS = ["repo_id", "repo_full_name", "repo_description", "primary_language",
                "stargazers_count", "star_bucket", "is_archived", "repo_created_at",
                "repo_pushed_at"]
USER_COLUMNS = ["user_id", "user_login", "user_type", "contributor_tier", "user_company",
                "public_repos", "followers", "user_created_at"]


# Fixed value: the closing day of versions that are current.
OPEN_DAY = date(9999, 12, 31)


@dataclass(frozen=True)
class Versioned:
    """A Type 2 dimension. Stored, its rows also carry ``seen_at``, the time of a version's last snapshot, and
    ``closed_on``, the day it closed, by which they are partitioned: what is current is one partition."""
    name: str
    key: str
    tracked: tuple[str, ...]
    columns: tuple[str, ...]
    order_col: str = "ingested_at"

    @property
    def sk(self) -> str:
        return f"dim_{self.key}"

    def versions(self, snapshots: DataFrame) -> DataFrame:
        """Versions of all ``snapshots``, with ``seen_at``."""
        return scd2(snapshots, self.key, self.order_col, list(self.tracked), self.sk, list(self.columns), seen="seen_at")

    def merge(self, current: DataFrame, fresh: DataFrame) -> DataFrame:
        return history.scd2_merge(current, fresh, self.key, self.order_col, list(self.tracked), self.sk, list(self.columns))

    def late_keys(self, current: DataFrame, fresh: DataFrame) -> DataFrame:
        return history.late_keys(current, fresh, self.key, self.order_col)

    @staticmethod
    def stored(versions: DataFrame) -> DataFrame:
        return versions.withColumn("closed_on", F.coalesce(F.to_date("valid_to"), F.lit(OPEN_DAY)))

    @staticmethod
    def published(rows: DataFrame) -> DataFrame:
        """The dimension as its users see it."""
        return rows.drop("seen_at", "closed_on")


REPOS = Versioned("dim_repos", "repo_id", ("star_bucket", "is_archived"), tuple(REPO_COLUMNS))
USERS = Versioned("dim_users", "user_id", ("contributor_tier",), tuple(USER_COLUMNS))


def repo_snapshots(stg_repos: DataFrame, small: int = SMALL_STARS, large: int = LARGE_STARS) -> DataFrame:
    return (stg_repos.select(*[c for c in REPO_COLUMNS if c != "star_bucket"], "ingested_at")
            .withColumn("star_bucket", star_bucket("stargazers_count", small, large)))


def user_snapshots(stg_users: DataFrame, tiers: DataFrame) -> DataFrame:
    """Users meet their tier at the same snapshot."""
    u = stg_users.select("user_id", "user_login", "user_type", "user_company", "public_repos",
                         "followers", "user_created_at", "ingested_at")
    t = tiers.select("user_id", F.col("snapshot_at").alias("ingested_at"), "contributor_tier")
    return u.join(t, ["user_id", "ingested_at"], "inner")


def dim_repos(stg_repos: DataFrame, small: int = SMALL_STARS, large: int = LARGE_STARS) -> DataFrame:
    """Repo versions on (star_bucket, is_archived)."""
    return REPOS.versions(repo_snapshots(stg_repos, small, large)).drop("seen_at")


def dim_users(stg_users: DataFrame, tiers: DataFrame) -> DataFrame:
    """User versions on contributor_tier."""
    return USERS.versions(user_snapshots(stg_users, tiers)).drop("seen_at")


def dim_languages(dim_repos_df: DataFrame) -> DataFrame:
    """Distinct non-null languages over every repo version, with a hash key."""
    langs = (dim_repos_df.filter(F.col("primary_language").isNotNull())
             .select(F.col("primary_language").alias("language_name")).distinct())
    return langs.select(surrogate_key(langs, "language_name").alias("dim_language_id"), "language_name")


def _calendar(days: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return days.select(
        d,
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_of_year"),
        F.month(d).alias("month_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("iso_week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        week_start(d).alias("week_start_date"),
    )


def dim_dates(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day in [start, end] with calendar attributes."""
    one = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))
    return _calendar(one)


def calendar_span(first: date, last: date, margin_years: int = CALENDAR_MARGIN_YEARS) -> tuple[date, date]:
    """First and last calendar day for events from ``first`` to ``last``."""
    return date(first.year, 1, 1), date(last.year + margin_years, 12, 31)


def dim_dates_covering(df: DataFrame, date_col: str,
                       margin_years: int = CALENDAR_MARGIN_YEARS) -> DataFrame:
    """Calendar from the first day of the earliest year in ``date_col`` to the
    last day ``margin_years`` years after the latest year: the data-driven form
    of the fixed 2024-01-01..2027-12-31 range (equal to it for 2024 data).
    The bounds are one aggregate over the column; the generated rows are
    bounded by the span in days."""
    d: Column = F.col(date_col)
    bounds = df.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    days = bounds.select(F.explode(F.sequence(
        F.trunc(F.col("_lo"), "year"),
        F.make_date(F.year(F.col("_hi")) + margin_years, F.lit(12), F.lit(31)))).alias("date_day"))
    return _calendar(days)
