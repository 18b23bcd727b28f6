"""Randomized checks of the two rewritten operators against brute force."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import FCT
from pulse.operators import history

BASE = dt.datetime(2024, 1, 1)
# Times on a coarse grid (hours) so ties, midnights and exact boundaries occur often.
hours = st.integers(0, 24 * 6)


def fact_rows(events):
    rows = []
    for n, (actor, repo, h) in enumerate(events):
        t = BASE + dt.timedelta(hours=h)
        rows.append((str(n), "PushEvent", t, t.date(), actor, f"u{actor}", repo, f"r{repo}", None, None, True))
    return rows


@settings(max_examples=12, deadline=None)
@given(events=st.lists(st.tuples(st.integers(1, 3), st.integers(1, 4), hours), max_size=25),
       snaps=st.lists(st.tuples(st.integers(1, 4), hours), min_size=1, max_size=8))
def test_tiers_equal_brute_force(spark_hyp, events, snaps):
    spark = spark_hyp
    users = spark.createDataFrame(
        sorted({(u, BASE + dt.timedelta(hours=h)) for u, h in snaps}),
        "user_id bigint, ingested_at timestamp")
    fct = spark.createDataFrame(fact_rows(events), FCT)
    got = {(r["user_id"], r["snapshot_at"]): (r["first_event_at"], r["distinct_repos"])
           for r in history.contributor_tiers(users, fct).collect()}
    want = {}
    for u, h in {(u, h) for u, h in snaps}:
        at = BASE + dt.timedelta(hours=h)
        seen = [(BASE + dt.timedelta(hours=eh), repo) for a, repo, eh in events
                if a == u and BASE + dt.timedelta(hours=eh) <= at]
        want[(u, at)] = (min((t for t, _ in seen), default=None), len({r for _, r in seen}))
    assert got == want


@settings(max_examples=12, deadline=None)
@given(cuts=st.lists(st.lists(hours, min_size=1, max_size=4), min_size=1, max_size=3),
       events=st.lists(st.tuples(st.integers(0, 2), hours), max_size=25))
def test_as_of_join_equals_brute_force(spark_hyp, cuts, events):
    spark = spark_hyp
    versions = []                       # (key, sk, valid_from, valid_to)
    for key, starts in enumerate(cuts):
        times = sorted({BASE + dt.timedelta(hours=h) for h in starts})
        for k, t in enumerate(times):
            end = times[k + 1] if k + 1 < len(times) else None
            versions.append((key, f"{key}-{k}", t, end))
    dim = spark.createDataFrame(versions, "k bigint, sk string, valid_from timestamp, valid_to timestamp")
    fact_list = [(str(n), key, BASE + dt.timedelta(hours=h)) for n, (key, h) in enumerate(events)]
    fact = spark.createDataFrame(fact_list, "event_id string, k bigint, at timestamp")
    got = {r["event_id"]: r["sk"] for r in history.as_of_join(fact, dim, "k", "at", ["sk"], span="day").collect()}
    want = {}
    for eid, key, at in fact_list:
        match = [sk for k, sk, f, t in versions if k == key and f <= at and (t is None or at < t)]
        assert len(match) <= 1
        want[eid] = match[0] if match else None
    assert got == want
