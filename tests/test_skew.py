"""Hot keys spread over many input partitions: the map-side partial limits and
aggregations must still give the exact answer."""

import datetime as dt
import random

from helpers import contributor_tiers_direct, dim, fct
from pulse.operators import history, marts, staging
from pulse.plans.inspect import plan_tree

AS_OF = dt.date(2024, 1, 31)


def test_hot_actor_first_two_prs_exact(spark):
    rnd = random.Random(7)
    times = [dt.datetime(2024, 1, 2) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 25)) for _ in range(3000)]
    events = [(f"h{k}", "PullRequestEvent", t.isoformat(sep=" "), 1, 1 + k % 3) for k, t in enumerate(times)]
    events += [("c1", "PullRequestEvent", "2024-01-05 00:00:00", 2, 1),
               ("c2", "PullRequestEvent", "2024-01-06 01:00:00", 2, 2)]
    f = fct(spark, events).repartition(16)
    df = marts.pr_velocity(dim(spark, [(1, "Go", 5), (2, "Go", 5), (3, "Go", 5)]), f, AS_OF)
    assert "WindowGroupLimit" in plan_tree(df)
    got = {r["actor_id"]: (r["first_pr_at"], r["second_pr_at"]) for r in df.collect()}
    first, second = sorted(times)[:2]
    assert got == {1: (first, second),
                   2: (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6, 1))}


def test_hot_duplicate_group_keeps_earliest_copy(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(4000):   # one id with 4000 copies at different times
        t = dt.datetime(2024, 1, 10) + dt.timedelta(seconds=rnd.randrange(1, 86000))
        rows.append(("hot", "PushEvent", t, (1, "u1"), (5, "o/r5"), None, True, t.date()))
    rows.append(("hot", "PushEvent", dt.datetime(2024, 1, 10), (9, "u9"), (5, "o/r5"), None, True,
                 dt.date(2024, 1, 10)))
    rows.append(("cold", "PushEvent", dt.datetime(2024, 1, 11), (2, "u2"), (6, "o/r6"), None, True,
                 dt.date(2024, 1, 11)))
    schema = ("id string, type string, created_at timestamp, actor struct<id:bigint,login:string>, "
              "repo struct<id:bigint,name:string>, org struct<id:bigint,login:string>, public boolean, "
              "dt date")
    raw = spark.createDataFrame(rows, schema).repartition(16)
    out = {r["event_id"]: r for r in staging.stage_events(raw, AS_OF).collect()}
    assert set(out) == {"hot", "cold"}
    assert out["hot"]["actor_id"] == 9 and out["hot"]["event_at"] == dt.datetime(2024, 1, 10)


def test_hot_repo_health_counts_exact(spark):
    events = [(f"e{k}", "PushEvent", "2024-01-10 10:00:00", 1 if k % 10 else 2 + k, 1)
              for k in range(5000)]
    f = fct(spark, events).repartition(16)
    row = marts.repo_health(dim(spark, [(1, "Go", 5)]), f, AS_OF).collect()[0]
    assert row["events_90d"] == 5000 and row["contributors_90d"] == 1 + 500
    assert row["top_contributor_share"] == 0.9 and row["bus_factor_label"] == "bus_factor_1"


def test_hot_user_tiers_exact(spark):
    events = [(f"e{k}", "PushEvent", f"2024-01-{1 + k % 20:02d} 10:00:00", 1, k % 300) for k in range(6000)]
    f = fct(spark, events).repartition(16)
    users = spark.createDataFrame([(1, dt.datetime(2024, 1, 10, 10)), (1, dt.datetime(2024, 1, 25))],
                                  "user_id bigint, ingested_at timestamp")
    got = {r["snapshot_at"]: r["distinct_repos"]
           for r in history.contributor_tiers(users, f).collect()}
    direct = {r["snapshot_at"]: r["distinct_repos"]
              for r in contributor_tiers_direct(users, f).collect()}
    assert got == direct and got[dt.datetime(2024, 1, 25)] == 300
