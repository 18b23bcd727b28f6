"""Column expressions with the reference's exact semantics.

Each helper returns a ``Column`` built from ``pyspark.sql.functions`` only, so
it stays inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

ColumnOrName = Column | str

# Star-bucket bounds (stars < 100 small, < 10000 medium, else large).
SMALL_STARS = 100
LARGE_STARS = 10000

# Bus-factor share thresholds (strict, on the unrounded share).
BUS_FACTOR_1_SHARE = 0.8
BUS_FACTOR_LOW_SHARE = 0.5

# Contributor tier defaults.
NEW_DAYS = 30
CORE_REPOS = 10
CORE_DAYS = 365

_NULL_TOKEN = "<null>"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts(text: str) -> Column:
    """A TIMESTAMP literal parsed in the session time zone (UTC)."""
    return F.lit(text).cast("timestamp")


def blank_to_null(c: ColumnOrName) -> Column:
    """Empty string -> null; other values pass through."""
    return F.nullif(_col(c), F.lit(""))


def is_distinct_from(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Null-safe inequality (SQL ``IS DISTINCT FROM``)."""
    return ~_col(a).eqNullSafe(_col(b))


def star_bucket(stars: ColumnOrName, small: int = SMALL_STARS,
                large: int = LARGE_STARS) -> Column:
    """small / medium / large; a null count falls through to ``large``."""
    s = _col(stars)
    return (F.when(s < small, "small")
            .when(s < large, "medium")
            .otherwise("large"))


def contributor_tier(first_event_at: ColumnOrName, distinct_repos: ColumnOrName,
                     snapshot_date: ColumnOrName, new_days: int = NEW_DAYS,
                     core_repos: int = CORE_REPOS, core_days: int = CORE_DAYS) -> Column:
    """Tier rule in its coded order: the "new" age test precedes the repo count."""
    first = _col(first_event_at)
    age = F.datediff(_col(snapshot_date), F.to_date(first))
    return (F.when(first.isNull(), "new")
            .when(age < new_days, "new")
            .when(_col(distinct_repos) >= core_repos, "core")
            .when(age > core_days, "core")
            .otherwise("regular"))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Double ratio that is null when the denominator is zero or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def bus_factor_label(events: ColumnOrName, top_events: ColumnOrName) -> Column:
    share = safe_ratio(top_events, events)
    return (F.when(_col(events).isNull(), "inactive")
            .when(share > BUS_FACTOR_1_SHARE, "bus_factor_1")
            .when(share > BUS_FACTOR_LOW_SHARE, "bus_factor_low")
            .otherwise("healthy_pyramid"))


def week_start(d: ColumnOrName, first_day: str = "SUN") -> Column:
    """Start of the week holding ``d``; weeks begin on ``first_day`` (default Sunday)."""
    return F.date_sub(F.next_day(_col(d), first_day), 7)


def whole_hour_days(start: ColumnOrName, end: ColumnOrName, digits: int = 2) -> Column:
    """Whole hours between two times (truncated), divided by 24, rounded."""
    hours = F.timestamp_diff("HOUR", _col(start), _col(end))
    return F.round(hours.cast("double") / F.lit(24.0), digits)


def _key_text(c: Column, data_type=None) -> Column:
    if isinstance(data_type, TimestampType):
        c = F.unix_micros(c)
    return F.coalesce(c.cast("string"), F.lit(_NULL_TOKEN))


def surrogate_key(df_or_types, *cols: str) -> Column:
    """Deterministic md5 key over ``cols``; timestamps hash as epoch microseconds.

    ``df_or_types`` is the DataFrame the columns come from (for their types).
    """
    schema = df_or_types.schema
    parts = [_key_text(F.col(c), schema[c].dataType) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
