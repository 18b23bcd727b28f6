"""SCD2: when a version opens, what it carries, corner cases, and a property test over
random snapshot histories."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse.operators.dims import dim_repos
from pulse.operators.history import scd2

REPO_SCHEMA = ("repo_id bigint, stargazers_count bigint, is_archived boolean, ingested_at timestamp, "
               "repo_full_name string, primary_language string, repo_description string, "
               "repo_created_at timestamp, repo_pushed_at timestamp")


def T(s):
    return dt.datetime.fromisoformat(s)


def repos(spark, rows):
    full = [(r[0], r[1], r[2], T(r[3]), "a/b", "Go", "x", T("2020-01-01 00:00:00"), T(r[3]))
            for r in rows]
    return spark.createDataFrame(full, REPO_SCHEMA)


def versions(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def test_crossing_both_star_limits_opens_two_versions(spark):
    d = dim_repos(repos(spark, [(41, 99, True, "2025-07-02 08:30:00"),
                                (41, 100, True, "2025-07-09 08:30:00"),
                                (41, 9999, True, "2025-07-16 08:30:00"),
                                (41, 10000, True, "2025-07-23 08:30:00")]))
    assert versions(d, "valid_from", "star_bucket", "valid_to") == [
        (T("2025-07-02 08:30:00"), "small", T("2025-07-09 08:30:00")),
        (T("2025-07-09 08:30:00"), "medium", T("2025-07-23 08:30:00")),
        (T("2025-07-23 08:30:00"), "large", None)]
    assert {r["valid_from"]: r["stargazers_count"] for r in d.collect()}[T("2025-07-09 08:30:00")] == 9999


def test_other_columns_never_open_a_version(spark):
    rows = [(42, 640 + 7 * k, False, f"2025-11-{k + 1:02d} 23:59:59") for k in range(12)]
    d = dim_repos(repos(spark, rows).withColumn("primary_language", F.col("stargazers_count").cast("string")))
    only, = d.collect()
    assert (only["valid_from"], only["valid_to"], only["is_current"]) == (T("2025-11-01 23:59:59"), None, True)
    assert (only["stargazers_count"], only["primary_language"]) == (717, "717")


def test_unarchiving_opens_a_version_too(spark):
    d = dim_repos(repos(spark, [(43, 20, True, "2024-02-28 00:00:00"), (43, 20, True, "2024-02-29 00:00:00"),
                                (43, 20, False, "2024-03-01 00:00:00")]))
    assert versions(d, "valid_from", "is_archived", "is_current") == [
        (T("2024-02-28 00:00:00"), True, False), (T("2024-03-01 00:00:00"), False, True)]


def test_snapshots_at_one_time_give_one_version(spark):
    rows = [(44, 5, False, "2025-01-01 00:00:00"), (44, 50000, False, "2025-01-01 00:00:00"),
            (44, 500, False, "2025-01-02 00:00:00")]
    one, two = (sorted(map(tuple, dim_repos(repos(spark, r)).collect()), key=str) for r in (rows, rows[::-1]))
    assert one == two and len({r[0] for r in one}) == len(one)
    assert all(r[-2] is None or r[-3] < r[-2] for r in one)


def test_a_b_a_gives_three_versions(spark):
    d = dim_repos(repos(spark, [(4, 5, False, "2026-03-01 00:00:00"),
                                (4, 500, False, "2026-03-02 00:00:00"),
                                (4, 6, False, "2026-03-03 00:00:00")]))
    assert [v[0] for v in versions(d, "valid_from", "star_bucket")] == [
        T("2026-03-01 00:00:00"), T("2026-03-02 00:00:00"), T("2026-03-03 00:00:00")]


def test_null_stars_fall_to_large(spark):
    d = dim_repos(repos(spark, [(5, None, False, "2026-03-01 00:00:00")]))
    assert versions(d, "star_bucket") == [("large",)]


def test_all_null_tracked_first_snapshot(spark):
    df = spark.createDataFrame(
        [(6, None, T("2026-03-01 00:00:00")), (6, None, T("2026-03-02 00:00:00")),
         (6, "x", T("2026-03-03 00:00:00"))], "k bigint, v string, t timestamp")
    out = scd2(df, "k", "t", ["v"], "sk")
    assert versions(out, "v", "valid_from", "valid_to") == [
        ("x", T("2026-03-03 00:00:00"), None),
        (None, T("2026-03-01 00:00:00"), T("2026-03-03 00:00:00"))]


def test_vanished_entity_stays_current_and_single_snapshot(spark):
    d = dim_repos(repos(spark, [(7, 5, False, "2026-03-01 00:00:00"),
                                (8, 5, False, "2026-03-01 00:00:00"),
                                (8, 5, False, "2026-03-09 00:00:00")]))
    cur = {r["repo_id"]: r["is_current"] for r in d.collect()}
    assert cur == {7: True, 8: True}


def test_surrogate_keys_unique_and_deterministic(spark):
    rows = [(9, 50, False, "2026-03-01 00:00:00"), (9, 5000, False, "2026-04-01 00:00:00")]
    a = sorted(r["dim_repo_id"] for r in dim_repos(repos(spark, rows)).collect())
    b = sorted(r["dim_repo_id"] for r in dim_repos(repos(spark, rows)).collect())
    assert a == b and len(set(a)) == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.sampled_from(["a", "b", None])),
                min_size=1, max_size=30))
def test_versions_tile_each_timeline(spark_hyp, snaps):
    spark = spark_hyp
    seen, rows = set(), []
    for key, day, val in snaps:
        if (key, day) in seen:
            continue
        seen.add((key, day))
        rows.append((key, val, dt.datetime(2026, 1, 1) + dt.timedelta(days=day)))
    df = spark.createDataFrame(rows, "k bigint, v string, t timestamp")
    out = [r.asDict() for r in scd2(df, "k", "t", ["v"], "sk").collect()]
    for key in {r[0] for r in rows}:
        vs = sorted((r for r in out if r["k"] == key), key=lambda r: r["valid_from"])
        first = min(t for k, _, t in rows if k == key)
        assert vs[0]["valid_from"] == first
        for a, b in zip(vs, vs[1:]):
            assert a["valid_to"] == b["valid_from"]          # no gap, no overlap
            assert a["v"] != b["v"]                           # adjacent versions differ
        assert vs[-1]["valid_to"] is None and vs[-1]["is_current"]
        assert sum(r["is_current"] for r in vs) == 1
