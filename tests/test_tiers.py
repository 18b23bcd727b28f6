"""Contributor tiers as of each snapshot: rule cases and the rewrite check."""

import datetime as dt

import pytest

from conftest import SF
from helpers import contributor_tiers_direct, T, fct
from pulse.operators import history, staging
from pulse.sources import standins

AS_OF = dt.date(2024, 1, 31)


def users(spark, rows):
    return spark.createDataFrame([(u, T(t)) for u, t in rows], "user_id bigint, ingested_at timestamp")


def tier_of(spark, events, snapshot="2025-06-01 00:00:00", **kw):
    u = users(spark, [(1, snapshot)])
    out = history.contributor_tiers(u, fct(spark, events), **kw).collect()
    assert len(out) == 1
    return out[0]["contributor_tier"], out[0]["distinct_repos"]


def ev(days_before, repos, snapshot="2025-06-01 00:00:00"):
    t = T(snapshot) - dt.timedelta(days=days_before)
    return [(f"e{i}", "PushEvent", t.isoformat(sep=" "), 1, 100 + i) for i in range(repos)]


def test_no_events_is_new(spark):
    assert tier_of(spark, [(0, "PushEvent", "2025-01-01 00:00:00", 2, 5)]) == ("new", 0)


def test_young_account_is_new_even_with_many_repos(spark):
    assert tier_of(spark, ev(29, 50)) == ("new", 50)


def test_thirty_days_nine_repos_regular(spark):
    assert tier_of(spark, ev(30, 9)) == ("regular", 9)


def test_thirty_days_ten_repos_core(spark):
    assert tier_of(spark, ev(30, 10)) == ("core", 10)


def test_year_old_one_repo_regular(spark):
    assert tier_of(spark, ev(365, 1)) == ("regular", 1)


def test_older_than_a_year_core(spark):
    assert tier_of(spark, ev(366, 1)) == ("core", 1)


def test_event_at_snapshot_counts_one_microsecond_later_does_not(spark):
    snap = "2025-06-01 00:00:00"
    at = [("a", "PushEvent", snap, 1, 1)]
    later = [("b", "PushEvent", "2025-06-01 00:00:00.000001", 1, 2)]
    assert tier_of(spark, at + later) == ("new", 1)


def test_repeat_repo_counts_once(spark):
    events = ev(40, 1) + ev(35, 1)
    assert tier_of(spark, events)[1] == 1


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_rewrite_equals_direct_join(spark, sf):
    raw = standins.raw_events(spark, SF[sf])
    fct_df = staging.stage_events(raw, AS_OF)
    fct_df = fct_df.filter("actor_id is not null and repo_id is not null")
    u = staging.stage_users(standins.raw_users(spark, SF[sf]))
    kw = dict(new_days=5, core_repos=25, core_days=24)
    a = history.contributor_tiers(u, fct_df, **kw)
    b = contributor_tiers_direct(u, fct_df, **kw)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_snapshots_same_day_split_by_time(spark):
    u = users(spark, [(1, "2025-06-01 10:00:00"), (1, "2025-06-01 20:00:00"), (1, "2025-06-02 09:00:00")])
    events = [("a", "PushEvent", "2025-05-31 23:00:00", 1, 1),
              ("b", "PushEvent", "2025-06-01 15:00:00", 1, 2),
              ("c", "PushEvent", "2025-06-01 15:00:00", 1, 1)]
    got = {str(r["snapshot_at"]): (r["distinct_repos"], str(r["first_event_at"]))
           for r in history.contributor_tiers(u, fct(spark, events)).collect()}
    assert got == {"2025-06-01 10:00:00": (1, "2025-05-31 23:00:00"),
                   "2025-06-01 20:00:00": (2, "2025-05-31 23:00:00"),
                   "2025-06-02 09:00:00": (2, "2025-05-31 23:00:00")}
    direct = {str(r["snapshot_at"]): r["distinct_repos"]
              for r in contributor_tiers_direct(u, fct(spark, events)).collect()}
    assert direct == {k: v[0] for k, v in got.items()}
