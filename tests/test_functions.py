"""Scalar expressions: boundaries and dialect traps."""

import datetime as dt

from pyspark.sql import functions as F

from pulse.functions import (blank_to_null, bus_factor_label, is_distinct_from, safe_ratio,
                             star_bucket, surrogate_key, week_start, whole_hour_days)
from pulse.streaming import windows


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).collect()[0]["v"]


def test_star_bucket_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 99, 100, 9999, 10000)], "s bigint")
    got = [r[0] for r in df.select(star_bucket("s")).collect()]
    assert got == ["large", "small", "small", "medium", "medium", "large"]


def test_week_starts_on_sunday_for_every_weekday(spark):
    days = [dt.date(2024, 1, 7) + dt.timedelta(days=i) for i in range(8)]   # Sun..Sun
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(week_start("d")).collect()]
    assert got == [dt.date(2024, 1, 7)] * 7 + [dt.date(2024, 1, 14)]


def test_week_start_parameter_monday(spark):
    assert one(spark, week_start(F.lit(dt.date(2024, 1, 7)), "MON")) == dt.date(2024, 1, 1)


def test_whole_hours_truncate_not_boundaries(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 2, 0)
    df = spark.createDataFrame([(a, b)], "a timestamp, b timestamp")
    assert df.select(F.timestamp_diff("HOUR", "a", "b")).collect()[0][0] == 1
    assert df.select(whole_hour_days("a", "b")).collect()[0][0] == round(1 / 24, 2)


def test_safe_ratio_and_labels(spark):
    df = spark.createDataFrame([(10, 8), (0, 0), (None, None), (10, 9), (2, 1)], "e bigint, t bigint")
    got = [(r[0], r[1]) for r in df.select(safe_ratio("t", "e"), bus_factor_label("e", "t")).collect()]
    assert got == [(0.8, "bus_factor_low"), (None, "healthy_pyramid"), (None, "inactive"),
                   (0.9, "bus_factor_1"), (0.5, "healthy_pyramid")]


def test_blank_to_null_and_distinct_from(spark):
    df = spark.createDataFrame([("", None), ("a", "a"), (None, None), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(blank_to_null("x")).collect()] == [None, "a", None, "a"]
    assert [r[0] for r in df.select(is_distinct_from("x", "y")).collect()] == [True, False, False, True]


def test_surrogate_key_uses_micros_and_null_token(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (None, None)], "k bigint, t timestamp")
    keys = [r[0] for r in df.select(surrogate_key(df, "k", "t")).collect()]
    import hashlib
    micros = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert keys[0] == hashlib.md5(f"1-{micros}".encode()).hexdigest()
    assert keys[1] == hashlib.md5(b"<null>-<null>").hexdigest()


def test_window_rules():
    w = windows.refresh_window(dt.date(2024, 1, 31), incremental=True)
    assert w.cutoff == dt.date(2024, 1, 28) and w.covers(dt.date(2024, 1, 28))
    assert not w.covers(dt.date(2024, 1, 27))
    assert windows.refresh_window(dt.date(2024, 1, 31), False).cutoff == dt.date(2023, 11, 2)
    assert windows.expiry_cutoff(dt.date(2024, 4, 15), 90) == dt.date(2024, 1, 16)


def test_shared_dir_is_the_sessions_checkpoint_folder(spark):
    from pulse.plans.queries import Inputs
    from pulse.session import shared_dir
    base = shared_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert Inputs(spark, "/unused").scratch("t").startswith(base + "/t-")
