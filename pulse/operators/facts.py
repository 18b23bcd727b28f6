"""The event fact (M7): a rolling window of staged events with valid keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.operators.staging import EVENT_COLUMNS
from pulse.streaming.windows import FACT_WINDOW_DAYS


def fct_events(stg: DataFrame, as_of: date, days: int = FACT_WINDOW_DAYS) -> DataFrame:
    """Events with ``event_date >= as_of - days`` (inclusive) and non-null actor and repo.

    ``event_date`` is the partition column of a stored staging table, so the
    window predicate prunes directories there.
    """
    return (stg.filter(F.col("event_date") >= F.date_sub(F.lit(as_of), days))
            .filter(F.col("actor_id").isNotNull() & F.col("repo_id").isNotNull())
            .select(*EVENT_COLUMNS))
