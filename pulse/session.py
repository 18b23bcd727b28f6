"""Session settings the library relies on.

The reference computes every date in UTC, so the session time zone must be UTC;
ANSI mode stays on (Spark 4 default) so bad casts fail loudly, and AQE re-plans
joins and shuffle sizes at run time. ``build_session`` is for tests and the
bench; on a cluster, pass the session you already have to ``configure``.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs for right answers (time zone) or for scale (AQE).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet nested-column pruning: read actor.id, not the whole actor struct.
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume. Idempotent."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "pulse") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    master = master or os.environ.get("PULSE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PULSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). A local
    session without one gets a fresh scratch folder; anywhere else a missing setting is
    an error, since every executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="pulse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return (sc.getCheckpointDir() or current).rstrip("/")
