"""What daily runs keep up: versions from new snapshots, marts and tiers from daily partials, touched days."""

import datetime as dt
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF
from helpers import FCT, dim, fct
from pulse import schemas
from pulse.operators import checks, dims, history, marts, partials, staging
from pulse.plans import jobs, queries
from pulse.plans.inspect import plan_text
from pulse.sources import ingest, standins, tables

AS_OF = dt.date(2024, 1, 31)
BASE = dt.datetime(2024, 1, 1)
SNAPS = "k bigint, v string, name string, t timestamp"
SPEC = dims.Versioned("dim_k", "k", ("v",), ("k", "v", "name"), "t")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def kept_up(spark, batches):
    """Versions after batches of snapshots in any order, by merging and by rebuilding late keys."""
    stored, history_ = None, None
    for batch in batches:
        fresh = spark.createDataFrame(batch, SNAPS)
        history_ = fresh if history_ is None else history_.unionByName(fresh)
        if stored is None:
            made = SPEC.versions(fresh)
        else:
            current = stored.filter("is_current")
            late = SPEC.late_keys(current, fresh)
            merged = SPEC.merge(current.join(late, "k", "left_anti"), fresh.join(late, "k", "left_anti"))
            closed = stored.filter("not is_current").join(late, "k", "left_anti").select(*stored.columns)
            rebuilt = SPEC.versions(history_.join(late, "k", "left_semi"))
            made = merged.select(*stored.columns).unionByName(closed).unionByName(rebuilt)
        stored = spark.createDataFrame(made.collect(), made.schema)
    return stored


@pytest.mark.parametrize("seed", range(4))
def test_any_arrival_order_equals_all_history(spark, seed):
    rng = random.Random(seed)
    snaps = [(k, rng.choice(["a", "b", None]), f"n{day}", BASE + dt.timedelta(days=day))
             for k in range(6) for day in rng.sample(range(20), rng.randrange(1, 9))]
    if seed % 2:
        snaps.sort(key=lambda s: s[3])  # in order: the merge alone
    else:
        rng.shuffle(snaps)
    size = -(-len(snaps) // 4)
    got = kept_up(spark, [snaps[at: at + size] for at in range(0, len(snaps), size)])
    assert rows_of(got) == rows_of(SPEC.versions(spark.createDataFrame(snaps, SNAPS)))


def test_merge_opens_extends_and_closes(spark):
    first = SPEC.versions(spark.createDataFrame([(k, "a", "old", BASE) for k in (1, 2, 3)], SNAPS))
    day = BASE + dt.timedelta(days=1)
    new = spark.createDataFrame([(1, "a", "new", day), (2, "b", "new", day), (4, "c", "new", day)], SNAPS)
    got = {(r.k, r.v, r.name, r.valid_from, r.valid_to, r.seen_at) for r in SPEC.merge(first, new).collect()}
    assert got == {(1, "a", "new", BASE, None, day), (2, "a", "old", BASE, day, BASE), (2, "b", "new", day, None, day),
                   (3, "a", "old", BASE, None, BASE), (4, "c", "new", day, None, day)}


def land_repos(spark, raw, days, path):
    some = raw.filter(F.to_date("ingested_at").isin([F.lit(d) for d in days]))
    ingest.land_snapshots(some, path, schemas.REPOS_REQUIRED)


def merged(spark, root, raw, full=False):
    cfg = jobs.PipelineConfig(root=f"{root}/out", raw_events="", raw_repos=raw, raw_users=raw, as_of=AS_OF, full=full)
    run = jobs._Run(spark, cfg)
    jobs._merge_dimension(run, dims.REPOS, "dim_repos", raw, lambda days: dims.repo_snapshots(
        staging.stage_repos(jobs._landed_days(run.raw_repos(), days))))
    return run.status["dim_repos"], run.dimension(dims.REPOS), cfg.path("dim_repos")


def test_stored_versions_follow_the_landed_days(spark, scratch):
    raw = standins.raw_repos(spark, SF["0.001"])
    days = sorted(r[0] for r in raw.select(F.to_date("ingested_at")).distinct().collect())
    path = os.path.join(scratch, "raw")
    whole = dims.dim_repos(staging.stage_repos(raw))

    land_repos(spark, raw, [d for d in days[:-4] if d != days[5]], path)
    assert merged(spark, scratch, path)[0] == "rebuilt"
    assert merged(spark, scratch, path)[0] == "unchanged"
    land_repos(spark, raw, days[-4:-2], path)                       # in order
    how, _, table = merged(spark, scratch, path)
    assert how == "merged"
    held = tables.days_in_force(spark, table)
    land_repos(spark, raw, days[-2:], path)
    assert merged(spark, scratch, path)[0] == "merged"
    now = tables.days_in_force(spark, table)
    untouched = {d for d in held if now[d] == held[d]}
    assert len(untouched) >= len(held) - 1 and dims.OPEN_DAY.isoformat() not in untouched  # closed versions stay in their files
    land_repos(spark, raw, [days[5]], path)                         # late
    how, got, _ = merged(spark, scratch, path)
    assert how == "merged" and rows_of(got) == rows_of(whole)
    land_repos(spark, raw.withColumn("stargazers_count", F.lit(1).cast("bigint")), [days[7]], path)  # landed again
    how, got, _ = merged(spark, scratch, path)
    assert how == "rebuilt"
    again = dims.dim_repos(staging.stage_repos(spark.read.parquet(path).drop("ingested_date")))
    assert rows_of(got) == rows_of(again)


def test_merging_reads_current_versions_and_new_days_only(spark, scratch):
    raw = standins.raw_repos(spark, SF["0.001"])
    path = os.path.join(scratch, "raw")
    days = sorted(r[0] for r in raw.select(F.to_date("ingested_at")).distinct().collect())
    land_repos(spark, raw, days, path)
    merged(spark, scratch, path)
    stored = tables.read(spark, f"{scratch}/out/dim_repos")
    current = stored.filter(F.col("closed_on") == F.lit(dims.OPEN_DAY))
    fresh = dims.repo_snapshots(staging.stage_repos(jobs._landed_days(spark.read.parquet(path), [days[-1].isoformat()])))
    plan = dims.REPOS.merge(current, fresh)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(" in line for line in scans)


# --- partials ---------------------------------------------------------------------

def test_marts_and_tiers_from_partials_equal_those_from_the_fact(spark):
    i = queries.Inputs(spark, SF["0.001"])
    activity, prs = partials.day_activity(i.fct), partials.day_prs(i.fct)
    assert rows_of(marts.repo_health(i.dim_repos, activity, AS_OF)) == rows_of(i.repo_health)
    assert rows_of(marts.language_trends(i.dim_repos, activity, AS_OF)) == rows_of(i.language_trends)
    assert rows_of(marts.pr_velocity(i.dim_repos, prs, AS_OF)) == rows_of(i.pr_velocity)
    tiers = history.contributor_tiers(i.stg_users, activity, queries.TIER_NEW_DAYS, queries.TIER_CORE_REPOS, queries.TIER_CORE_DAYS)
    assert rows_of(tiers) == rows_of(i.tiers)


def test_partial_of_a_busy_day_is_two_prs(spark):
    events = [(f"e{k}", "PullRequestEvent", f"2024-01-10 10:{k % 60:02d}:00", 1, 1) for k in range(500)]
    events += [("p", "PushEvent", "2024-01-10 09:00:00", 1, 1), ("q", "PullRequestEvent", "2024-01-11 00:00:00", 1, 1)]
    f = fct(spark, events).repartition(8)
    assert [(r.event_at, r.event_date.day) for r in partials.day_prs(f).orderBy("event_at").collect()] == [
        (dt.datetime(2024, 1, 10, 10), 10)] * 2 + [(dt.datetime(2024, 1, 11), 11)]
    got = {(r.event_date.day, r.n_events, r.first_at.hour) for r in partials.day_activity(f).collect()}
    assert got == {(10, 501, 9), (11, 1, 0)}
    assert "WindowGroupLimit" in partials.day_prs(f)._jdf.queryExecution().executedPlan().toString()
    assert marts.pr_velocity(dim(spark, [(1, "Go", 5)]), partials.day_prs(f), AS_OF).first().days_to_second_pr == 0.0


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    tables.replace_partitions(standins.raw_events(spark, SF["0.001"]), f"{root}/raw_events", "dt")
    ingest.land_snapshots(standins.raw_repos(spark, SF["0.001"]), f"{root}/raw_repos", schemas.REPOS_REQUIRED)
    ingest.land_snapshots(standins.raw_users(spark, SF["0.001"]), f"{root}/raw_users", schemas.USERS_REQUIRED)
    return root


def config(lake, out, **options):
    return jobs.PipelineConfig(**dict(dict(root=out, raw_events=f"{lake}/raw_events", raw_repos=f"{lake}/raw_repos",
                                           raw_users=f"{lake}/raw_users", as_of=AS_OF), **options))


def test_only_replaced_days_are_aggregated_again(spark, lake, tmp_path):
    c = config(lake, str(tmp_path / "out"))
    jobs.run_daily(spark, c)
    before = {n: tables.days_in_force(spark, c.path(n)) for n in ("day_activity", "day_prs", "fct_events", "stg_events")}
    jobs.run_daily(spark, c)
    for name, was in before.items():
        now = tables.days_in_force(spark, c.path(name))
        assert {d for d in now if now[d] != was[d]} == {"2024-01-28", "2024-01-29", "2024-01-30"}, name
    history_ = tables.read(spark, c.path("check_history"))
    assert history_.select("as_of").distinct().count() == 1
    jobs.run_daily(spark, replace(c, as_of=AS_OF + dt.timedelta(days=1)))
    per_run = {r.as_of: r["count"] for r in tables.read(spark, c.path("check_history")).groupBy("as_of").count().collect()}
    assert len(per_run) == 2 and len(set(per_run.values())) == 1


def test_flawed_days_leave_every_event_table_as_it_was(spark, lake, tmp_path):
    c = config(lake, str(tmp_path / "out"))
    jobs.run_daily(spark, c)
    names = ("stg_events", "fct_events", "day_activity", "day_prs", "mart_repo_health")
    kept = {n: tables.location(spark, c.path(n)) for n in names}
    rows = rows_of(tables.read(spark, c.path("fct_events"), schemas.STORED_EVENTS))
    bad = str(tmp_path / "bad")
    raw = spark.read.parquet(c.raw_events)
    tables.replace_partitions(raw.withColumn("type", F.when(F.col("dt") != F.lit(dt.date(2024, 1, 29)), F.col("type"))), bad, "dt")
    with pytest.raises(checks.CheckFailed) as stop:
        jobs.run_daily(spark, replace(c, raw_events=bad))
    assert "stg_events_event_type_not_null" in stop.value.failures
    assert kept == {n: tables.location(spark, c.path(n)) for n in names}
    assert rows_of(tables.read(spark, c.path("fct_events"), schemas.STORED_EVENTS)) == rows
    assert jobs.run_daily(spark, c)["fct_events"] == "incremental"


def test_run_that_died_while_publishing_is_finished_first(spark, lake, tmp_path, monkeypatch):
    c = config(lake, str(tmp_path / "out"))
    jobs.run_daily(spark, c)
    publish = tables.publish

    def dies(s, staged):
        if isinstance(staged, tables.Staged) and staged.path.endswith("fct_events"):
            raise KeyboardInterrupt
        publish(s, staged)

    monkeypatch.setattr(tables, "publish", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_daily(spark, c)
    monkeypatch.undo()
    def journals():
        return [n for n in os.listdir(os.path.join(c.root, "_journal")) if not n.startswith(".")]

    assert len(journals()) == 2
    assert c.path("fct_events") in tables.recover(spark, c.root)
    assert journals() == []
    assert tables.location(spark, c.path("day_prs")) != tables.location(spark, c.path("stg_events"))
    assert jobs.run_daily(spark, c)["fct_events"] == "incremental"


def test_counts_of_unchanged_days_are_kept(spark, lake, tmp_path):
    """An unknown event type is a warning; its day is not read again, and still counts."""
    odd = str(tmp_path / "odd")
    raw = spark.read.parquet(f"{lake}/raw_events")
    tables.replace_partitions(raw.withColumn("type", F.when(F.col("dt") == F.lit(dt.date(2024, 1, 5)), "OddEvent")
                                             .otherwise(F.col("type"))), odd, "dt")
    c = config(lake, str(tmp_path / "out"), raw_events=odd)
    counts = []
    for _ in range(2):
        jobs.run_daily(spark, c)
        row = tables.read(spark, c.path("check_results")).filter("`check` = 'fct_events_event_type_accepted'").first()
        counts.append((row.failures, row.status))
    n = tables.read(spark, c.path("fct_events")).filter("event_type = 'OddEvent'").count()
    assert counts == [(n, "warn")] * 2 and n > 0
    noted = tables.note(spark, c.path("fct_events"))["failures"]
    assert noted["2024-01-05"] == {"fct_events_event_type_accepted": n} and noted["2024-01-29"] == {}


# --- touched days -------------------------------------------------------------------

RAW = ("id string, type string, created_at timestamp, actor struct<id:bigint,login:string>, "
       "repo struct<id:bigint,name:string>, org struct<id:bigint,login:string>, public boolean, dt date")


def raw_rows(spark, events):
    """events: (id, day of January, hour, day table)."""
    return spark.createDataFrame([(i, "PushEvent", dt.datetime(2024, 1, d, h), (1, "u"), (1, "r"), None, True, dt.date(2024, 1, t))
                                  for i, d, h, t in events], RAW)


def test_late_copy_that_is_earliest_takes_its_neighbour_days_row(spark):
    on_time = [("a", 10, 5, 10), ("b", 11, 5, 11), ("c", 13, 5, 13), ("far", 25, 0, 25)]
    late = [("b", 10, 1, 10), ("n", 10, 2, 10), ("c", 10, 3, 11)]
    stored = staging.stage_events(raw_rows(spark, on_time), AS_OF)
    day = [dt.date(2024, 1, 10)]
    every = raw_rows(spark, on_time + late)
    rows = staging.stage_event_days(every, day)
    assert sorted(r.event_id for r in rows.collect()) == ["a", "b", "c", "n"]
    more = staging.outdated_days(stored, rows, day)
    assert more == [dt.date(2024, 1, 11), dt.date(2024, 1, 13)]
    touched = day + more
    again = staging.stage_event_days(every, touched)
    others = stored.filter(~F.col("event_date").isin([F.lit(d) for d in touched]))
    assert rows_of(others.unionByName(again)) == rows_of(staging.stage_events(every, AS_OF))


def test_touched_days_scan_their_neighbours_only(spark, lake):
    rows = staging.stage_event_days(spark.read.parquet(f"{lake}/raw_events"), [dt.date(2024, 1, 10)])
    pruned = next(line for line in plan_text(rows).splitlines() if line.startswith("PartitionFilters: [isnotnull(dt"))
    assert "2024-01-07" in pruned and "2024-01-13" in pruned and "2024-01-06" not in pruned


def test_day_whose_rows_all_went_leaves_the_tables(spark, lake, tmp_path):
    raw = str(tmp_path / "raw")
    tables.replace_partitions(spark.read.parquet(f"{lake}/raw_events"), raw, "dt")
    c = config(lake, str(tmp_path / "out"), raw_events=raw)
    jobs.run_daily(spark, c)
    import shutil
    shutil.rmtree(os.path.join(raw, "dt=2024-01-12"))
    jobs.run_daily(spark, replace(c, days=(dt.date(2024, 1, 12),)))
    for name in ("stg_events", "fct_events", "day_activity", "day_prs"):
        assert "2024-01-12" not in tables.partitions(spark, c.path(name), "event_date"), name
    full = spark.read.schema(jobs.RAW_EVENTS).parquet(raw)
    want = staging.stage_events(full, AS_OF).filter("actor_id is not null and repo_id is not null").count()
    assert tables.read(spark, c.path("fct_events")).count() == want


# --- as-of, overlaps --------------------------------------------------------------

def test_hot_key_is_spread_over_spans_and_no_row_is_copied(spark):
    rng = random.Random(5)
    cuts = sorted(rng.sample(range(24 * 20), 30))
    versions = [(1, f"v{n}", BASE + dt.timedelta(hours=h), BASE + dt.timedelta(hours=cuts[n + 1]) if n + 1 < len(cuts) else None)
                for n, h in enumerate(cuts)] + [(k, f"k{k}", BASE - dt.timedelta(days=400), BASE - dt.timedelta(days=300)) for k in range(2, 40)]
    dim_ = spark.createDataFrame(versions, "k bigint, sk string, valid_from timestamp, valid_to timestamp")
    events = [(n, 1 if n % 3 else rng.randrange(2, 60), BASE + dt.timedelta(minutes=rng.randrange(-600, 60 * 24 * 21))) for n in range(3000)]
    fact = spark.createDataFrame(events, "id bigint, k bigint, at timestamp").repartition(8)
    got = {r.id: r.sk for r in history.as_of_join(fact, dim_, "k", "at", ["sk"]).collect()}
    want = {n: next((s for kk, s, a, z in versions if kk == k and a <= at and (z is None or at < z)), None) for n, k, at in events}
    assert got == want
    lines = fact.groupBy("k", F.date_trunc("hour", "at")).count().agg(F.max("count")).first()[0]
    assert lines < 60  # the largest group of a task, of 2,000 rows of the hot key


def test_long_broken_key_is_compared_in_cells(spark):
    rows = [(1, f"v{n:04d}", BASE + dt.timedelta(minutes=n), BASE + dt.timedelta(minutes=n + 3)) for n in range(700)]
    rows += [(1, "all", BASE, None), (2, "x", BASE, None)]
    d = spark.createDataFrame(rows, "repo_id bigint, dim_repo_id string, valid_from timestamp, valid_to timestamp")
    end = lambda r: r[3] or dt.datetime(9999, 1, 1)
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and a[2] < end(b) and b[2] < end(a)}
    got = checks.no_overlap(d, "dim_repos", "repo_id", "dim_repo_id", chunk=64).collect()
    assert len(got) == len(want) and {(r.a_sk, r.b_sk) for r in got} == want


# --- malformed documents -----------------------------------------------------------

def test_malformed_lines_keep_text_file_and_reason(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    good = '{"id": 1, "full_name": "o/r", "owner": {"id": 5, "login": "u"}, "extra": 1}'
    lines = [good, '{"id": 2, "full_name"', '{"id": "x", "full_name": "o/x", "owner": {"id": 5}}',
             '{"id": 3, "full_name": "o/y", "owner": null}', '{"id": 4, "full_name": "o/z", "owner": {"id": "q"}, "fork": 7}',
             'not json at all', '[]']
    (docs / "one.json").write_text("\n".join(lines))
    read = ingest.read_documents(spark, str(docs), schemas.REPO_DOCUMENT, traces=True)
    rej = str(tmp_path / "rej")
    assert ingest.land_repos(spark, read, "2024-01-31 06:00:00", str(tmp_path / "out"), rej) == 1
    got = {r.line or r.identifier: (r.reason, r.file.rsplit("/", 1)[-1]) for r in spark.read.schema(
        "identifier string, reason string, line string, file string").json(rej).collect()}
    assert got[lines[1]] == ("malformed: not JSON", "one.json") == got[lines[5]]
    assert got[lines[2]][0] == "malformed: wrong type: id"
    assert got["3"][0] == "missing required: owner_id"
    assert got[lines[4]][0] == "malformed: wrong type: owner.id,fork"
    assert "_line" not in spark.read.parquet(str(tmp_path / "out")).columns
    targets = spark.createDataFrame([("o/r", True)], "full_name string, enabled boolean")
    assert len(ingest.only_tracked(read, targets, "full_name").collect()) >= 5  # malformed ones are reported, whoever they are


def test_plain_reading_is_unchanged(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"id": 1}\n{"id": ')
    assert ingest.read_documents(spark, str(tmp_path), schemas.REPO_DOCUMENT).columns == schemas.REPO_DOCUMENT.names


def test_fct_schema_helper_matches(spark):
    assert [f.split()[0] for f in FCT.split(", ")] == list(staging.EVENT_COLUMNS)
