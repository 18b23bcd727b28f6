"""Drive the daily job from arrived day tables (Structured Streaming, availableNow).

A file-source stream over the raw event day tables remembers, in its
checkpoint, which files were already processed. Each time this runs it picks
up only new files and runs the daily job once: as of the day after the newest arrived
day, but never before the last completed run, over the event days that the new files hold. A file
that comes 60 days late rewrites its own days and nothing else; days that have left the
window are left alone. A backlog is one run, and a crash mid-way resumes from the checkpoint (the job replaces
whole days, so replaying a batch is harmless).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from pulse import schemas
from pulse.plans import jobs
from pulse.streaming import windows


def raw_event_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming read of the day tables (Parquet, partitioned by ``dt``)."""
    schema = StructType([*schemas.EVENTS.fields, StructField("dt", DateType())])
    return spark.readStream.schema(schema).option("basePath", path).parquet(path)


def run_on_arrivals(spark: SparkSession, cfg: jobs.PipelineConfig, checkpoint: str,
                    run: Callable[[SparkSession, jobs.PipelineConfig], dict] = jobs.run_daily
                    ) -> list[str]:
    """Run ``run`` once for what has arrived; returns the run's date, nothing if no file is
    new. Only the arrived days reach the driver."""
    done: list[str] = []

    def per_batch(batch: DataFrame, _epoch: int) -> None:
        newest = batch.agg(F.max("dt")).first()[0]
        if newest is None:
            return
        as_of = newest + timedelta(days=1)
        before = jobs.last_run(spark, cfg)
        if before is not None:
            as_of = max(as_of, before)
        oldest = as_of - timedelta(days=windows.STAGING_WINDOW_DAYS)
        day = F.to_date("created_at")
        days = batch.filter(day.between(F.lit(oldest), F.lit(as_of))).select(day.alias("day")).distinct()
        arrived = tuple(sorted(r.day for r in days.collect()))  # days of the window
        if before is not None and not arrived:
            return
        run(spark, replace(cfg, as_of=as_of, days=arrived))
        done.append(as_of.isoformat())

    query = (raw_event_stream(spark, cfg.raw_events).select("dt", "created_at")
             .writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return done
