"""Mart cases: bus-factor thresholds, Sunday weeks, PR whole hours, null language."""

import datetime as dt

from helpers import dim, fct
from pulse.operators import marts

AS_OF = dt.date(2024, 1, 31)


def health(spark, repos, events):
    out = marts.repo_health(dim(spark, repos), fct(spark, events), AS_OF).collect()
    return {r["repo_id"]: r for r in out}


def _events(repo, counts, day="2024-01-10 10:00:00"):
    out, n = [], 0
    for actor, c in counts.items():
        for _ in range(c):
            out.append((f"{repo}-{n}", "PushEvent", day, actor, repo))
            n += 1
    return out


def test_share_exactly_point_eight_is_low(spark):
    h = health(spark, [(1, "Go", 5)], _events(1, {7: 8, 8: 2}))
    assert h[1]["top_contributor_share"] == 0.8 and h[1]["bus_factor_label"] == "bus_factor_low"


def test_share_above_point_eight_is_bus_factor_1(spark):
    h = health(spark, [(1, "Go", 5)], _events(1, {7: 9, 8: 1}))
    assert h[1]["bus_factor_label"] == "bus_factor_1"


def test_share_exactly_half_is_healthy(spark):
    h = health(spark, [(1, "Go", 5)], _events(1, {7: 5, 8: 3, 9: 2}))
    assert h[1]["bus_factor_label"] == "healthy_pyramid" and h[1]["contributors_90d"] == 3


def test_no_events_is_inactive(spark):
    h = health(spark, [(1, "Go", 5), (2, "Go", 5)], _events(1, {7: 1}))
    assert h[2]["bus_factor_label"] == "inactive" and h[2]["events_90d"] == 0
    assert h[2]["top_contributor_share"] is None


def test_events_outside_window_or_untracked_ignored(spark):
    ev = _events(1, {7: 1}, day="2023-10-01 00:00:00") + _events(99, {7: 5})
    h = health(spark, [(1, "Go", 5)], ev)
    assert set(h) == {1} and h[1]["bus_factor_label"] == "inactive"


def test_saturday_and_sunday_fall_in_different_weeks(spark):
    ev = [("a", "PushEvent", "2024-01-06 12:00:00", 1, 1),   # Saturday
          ("b", "PushEvent", "2024-01-07 12:00:00", 2, 1)]   # Sunday
    out = marts.language_trends(dim(spark, [(1, "Go", 5)]), fct(spark, ev), AS_OF).collect()
    weeks = sorted((r["week_start"], r["new_contributors"]) for r in out)
    assert weeks == [(dt.date(2023, 12, 31), 1), (dt.date(2024, 1, 7), 1)]


def test_null_language_gives_no_trend_row(spark):
    ev = [("a", "PushEvent", "2024-01-06 12:00:00", 1, 1)]
    assert marts.language_trends(dim(spark, [(1, None, 5)]), fct(spark, ev), AS_OF).count() == 0


def test_new_contributor_is_per_language(spark):
    ev = [("a", "PushEvent", "2024-01-03 12:00:00", 1, 1),
          ("b", "PushEvent", "2024-01-20 12:00:00", 1, 2),
          ("c", "PushEvent", "2024-01-21 12:00:00", 1, 1)]
    out = marts.language_trends(dim(spark, [(1, "Go", 5), (2, "C", 5)]), fct(spark, ev), AS_OF)
    got = sorted((r["language"], r["week_start"]) for r in out.collect())
    assert got == [("C", dt.date(2024, 1, 14)), ("Go", dt.date(2023, 12, 31))]


def test_pr_59_minutes_apart_is_zero_days_and_single_pr_no_row(spark):
    ev = [("a", "PullRequestEvent", "2024-01-10 00:59:00", 1, 1),
          ("b", "PullRequestEvent", "2024-01-10 01:58:00", 1, 1),
          ("c", "PullRequestEvent", "2024-01-10 00:00:00", 2, 1),
          ("d", "PushEvent", "2024-01-11 00:00:00", 2, 1)]
    out = {r["actor_id"]: r for r in marts.pr_velocity(dim(spark, [(1, "Go", 5)]),
                                                       fct(spark, ev), AS_OF).collect()}
    assert set(out) == {1} and out[1]["days_to_second_pr"] == 0.0


def test_whole_hours_truncate(spark):
    ev = [("a", "PullRequestEvent", "2024-01-10 00:59:00", 1, 1),
          ("b", "PullRequestEvent", "2024-01-11 02:00:00", 1, 1),
          ("c", "PullRequestEvent", "2024-01-12 02:00:00", 1, 1)]
    out = marts.pr_velocity(dim(spark, [(1, "Go", 5)]), fct(spark, ev), AS_OF).collect()
    assert out[0]["days_to_second_pr"] == round(25 / 24, 2)


def test_exact_median_and_histogram(spark):
    v = spark.createDataFrame([(i, d) for i, d in enumerate([1.0, 2.0, 4.0, 9.0])],
                              "actor_id bigint, days_to_second_pr double")
    assert marts.panel_velocity_median(v).collect()[0]["median_days"] == 3.0
    hist = sorted(tuple(r) for r in marts.panel_velocity_hist(v).collect())
    assert hist == [(1.0, 1), (2.0, 1), (4.0, 1), (9.0, 1)]
