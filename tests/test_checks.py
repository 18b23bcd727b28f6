"""Each data-quality check with one passing and one failing input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import T
from pulse import schemas
from pulse.operators import checks

NOW = dt.datetime(2024, 1, 31)


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_not_null(spark):
    ok = df(spark, [(1, "a")], "k bigint, v string")
    bad = df(spark, [(1, None)], "k bigint, v string")
    assert ok.filter(checks.null_in("k", "v")).count() == 0 and bad.filter(checks.null_in("v")).count() == 1


def test_unique_and_combination(spark):
    d = df(spark, [(1, 1), (1, 2), (2, 1), (None, 1), (None, 1)], "a bigint, b bigint")
    assert [r["a"] for r in checks.unique(d, "a").collect()] == [1]     # nulls never fail
    assert checks.unique(d, "a", "b").count() == 0


def test_accepted_values(spark):
    d = df(spark, [("PushEvent",), ("Nope",), (None,)], "event_type string")
    assert [r[0] for r in d.filter(checks.outside("event_type", schemas.EVENT_TYPES)).collect()] == ["Nope"]


def test_relationships(spark):
    child = df(spark, [(1, 10), (2, 11), (3, None)], "repo_id bigint, owner_id bigint")
    parent = df(spark, [(10,)], "user_id bigint")
    assert [r["repo_id"] for r in checks.relationships(child, "owner_id", parent, "user_id").collect()] == [2]


def test_recency_pass_and_fail(spark):
    fresh = df(spark, [(T("2024-01-29 00:00:00"),)], "event_at timestamp")
    stale = df(spark, [(T("2024-01-28 23:59:59"),)], "event_at timestamp")
    assert checks.recency(fresh, "event_at", NOW, 48).count() == 0
    assert checks.recency(stale, "event_at", NOW, 48).count() == 1
    assert checks.recency(fresh.limit(0), "event_at", NOW, 48).count() == 1


def test_no_future_events(spark):
    d = df(spark, [("a", T("2024-01-30 00:00:00")), ("b", T("2024-02-01 00:00:00"))],
           "event_id string, event_at timestamp")
    assert [r["event_id"] for r in d.filter(checks.after("event_at", NOW)).collect()] == ["b"]


def test_orgs_dont_follow(spark):
    d = df(spark, [(1, "o", "Organization", 0), (2, "p", "Organization", 3), (3, "u", "User", 5)],
           "user_id bigint, user_login string, user_type string, following bigint")
    assert [r["user_id"] for r in d.filter(checks.org_follows()).collect()] == [2]


def test_no_overlap(spark):
    schema = "repo_id bigint, dim_repo_id string, valid_from timestamp, valid_to timestamp"
    good = df(spark, [(1, "a", T("2024-01-01 00:00:00"), T("2024-01-05 00:00:00")),
                      (1, "b", T("2024-01-05 00:00:00"), None)], schema)
    bad = df(spark, [(1, "a", T("2024-01-01 00:00:00"), None),
                     (1, "b", T("2024-01-05 00:00:00"), None)], schema)
    assert checks.no_overlap(good, "dim_repos", "repo_id", "dim_repo_id").count() == 0
    assert {(r["a_sk"], r["b_sk"]) for r in checks.no_overlap(bad, "dim_repos", "repo_id", "dim_repo_id").collect()} == {
        ("a", "b"), ("b", "a")}


def test_every_overlapping_pair_is_found(spark):
    """A version that covers two others, and neighbours that only touch."""
    schema = "repo_id bigint, dim_repo_id string, valid_from timestamp, valid_to timestamp"
    rows = [(1, "long", T("2024-01-01 00:00:00"), T("2024-03-01 00:00:00")),
            (1, "x", T("2024-01-05 00:00:00"), T("2024-01-09 00:00:00")),
            (1, "y", T("2024-02-01 00:00:00"), T("2024-02-09 00:00:00")),
            (1, "next", T("2024-03-01 00:00:00"), None),
            (2, "other", T("2024-01-01 00:00:00"), None)]
    got = checks.no_overlap(df(spark, rows, schema), "dim_repos", "repo_id", "dim_repo_id").collect()
    assert {(r["a_sk"], r["b_sk"]) for r in got} == {("long", "x"), ("x", "long"), ("long", "y"), ("y", "long")}


def test_where_scopes_rows_and_severity(spark):
    d = df(spark, [("x", dt.date(2024, 1, 1)), ("x", dt.date(2024, 1, 2)), ("y", dt.date(2024, 1, 30)),
                   ("y", dt.date(2024, 1, 30))], "event_id string, event_date date")
    recent = checks.Check("u7", "fct", lambda x: checks.unique(x, "event_id"),
                          where="event_date >= date'2024-01-24'", severity="warn")
    only_y = checks.Check("no_y", "fct", bad=F.col("event_id") == "y", where="event_date >= date'2024-01-30'")
    rows = checks.summary([recent, only_y], {"fct": lambda: d}).collect()
    assert {(r["check"], r["failures"], r["status"]) for r in rows} == {("u7", 1, "warn"), ("no_y", 2, "fail")}
    checks.gate([r for r in rows if r["check"] == "u7"])
    with pytest.raises(checks.CheckFailed) as stop:
        checks.gate(rows)
    assert stop.value.failures == {"no_y": 2}


def test_row_checks_of_a_model_are_one_scan(spark):
    from pulse.operators import declared
    from pulse.plans.inspect import plan_text
    from pulse.plans.queries import Inputs
    from conftest import SF
    users = Inputs(spark, SF["0.001"]).model("stg_repos")
    row_checks = [c for c in declared.declared("stg_repos", NOW.date(), NOW) if c.bad is not None]
    assert len(row_checks) >= 7
    plan = plan_text(checks.summary(row_checks, {"stg_repos": lambda: users}), "simple")
    assert plan.count("FileScan parquet") == 1


def test_schema_equals(spark):
    d = df(spark, [(1, "a")], "id bigint, login string")
    assert checks.schema_equals(d, d.schema).count() == 0
    assert [(r["column"], r["problem"], r["n_rows"]) for r in checks.schema_equals(d.drop("login"), d.schema).collect()] == [
        ("login", "missing", 1)]


def test_freshness_levels(spark):
    d = df(spark, [(T("2024-01-29 00:00:00"),)], "ingested_at timestamp")
    r = checks.freshness(d, "users", "ingested_at", NOW, 25, 48).collect()[0]
    assert (r["age_hours"], r["status"]) == (48.0, "warn")
    r = checks.freshness(d, "users", "ingested_at", NOW, 25, 47).collect()[0]
    assert r["status"] == "error"
    r = checks.freshness(d, "users", "ingested_at", NOW, 49, 72).collect()[0]
    assert r["status"] == "pass"
