"""Daily partials of the event fact: what a day adds to the marts and the contributor tiers.

Each is kept by the day, so a replaced day is aggregated again and the others are read as they are.
Partials of any days combine: counts add up, the first touch is the smallest, and the two first
pull requests of a window are among the two first of its days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampType

from pulse.operators.marts import PR_EVENT

#: Pull requests of an actor on a repo that a day keeps: velocity looks at the first two.
FIRST_PRS = 2

DAY_ACTIVITY = StructType([
    StructField("actor_id", LongType()), StructField("repo_id", LongType()), StructField("n_events", LongType()),
    StructField("first_at", TimestampType()), StructField("event_date", DateType())])
DAY_PRS = StructType([
    StructField("actor_id", LongType()), StructField("repo_id", LongType()), StructField("event_at", TimestampType()),
    StructField("event_date", DateType())])


def day_activity(fct: DataFrame) -> DataFrame:
    """(actor, repo, day) -> events and the first one's time. Combines before its shuffle, so a hot actor or
    repo sends one row from each task."""
    return (fct.groupBy("actor_id", "repo_id", "event_date")
            .agg(F.count(F.lit(1)).alias("n_events"), F.min("event_at").alias("first_at"))
            .select(*DAY_ACTIVITY.names))


def day_prs(fct: DataFrame) -> DataFrame:
    """The first two pull-request times of each (actor, repo, day). A partial limit runs before the shuffle, so a
    bot with millions of them sends two rows from each task."""
    first = Window.partitionBy("actor_id", "repo_id", "event_date").orderBy("event_at")
    return (fct.filter(F.col("event_type") == PR_EVENT).select(*DAY_PRS.names)
            .withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= FIRST_PRS)
            .select(*DAY_PRS.names))
