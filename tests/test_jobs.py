"""Daily vs weekly jobs and the arrivals driver."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF
from pulse import schemas
from pulse.operators import checks
from pulse.plans import jobs
from pulse.sources import ingest, standins, tables
from pulse.streaming import arrivals

AS_OF = dt.date(2024, 1, 31)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw_events = os.path.join(root, "raw_events")
    tables.replace_partitions(standins.raw_events(spark, SF["0.001"]), raw_events, "dt")
    ingest.land_snapshots(standins.raw_repos(spark, SF["0.001"]), os.path.join(root, "raw_repos"),
                          schemas.REPOS_REQUIRED)
    ingest.land_snapshots(standins.raw_users(spark, SF["0.001"]), os.path.join(root, "raw_users"),
                          schemas.USERS_REQUIRED)
    return root


def cfg(root, out):
    return jobs.PipelineConfig(root=out, raw_events=os.path.join(root, "raw_events"),
                               raw_repos=os.path.join(root, "raw_repos"),
                               raw_users=os.path.join(root, "raw_users"), as_of=AS_OF,
                               tier_params=dict(new_days=5, core_repos=25, core_days=24))


def test_daily_then_weekly(spark, landed, tmp_path):
    c = cfg(landed, str(tmp_path / "out"))
    status = jobs.run_daily(spark, c)
    assert status["fct_events"] == "full"
    assert not os.path.exists(c.path("int_user_contributor_tier_snapshots"))
    assert not os.path.exists(c.path("dim_users"))
    assert tables.read(spark, c.path("mart_repo_health")).count() > 0
    results = {r["check"]: r["status"] for r in tables.read(spark, c.path("check_results")).collect()}
    assert results["fct_events_actor_id_not_null"] == "pass" and "dim_users_no_overlap" not in results

    jobs.run_weekly(spark, c)
    tier_path = c.path("int_user_contributor_tier_snapshots")
    assert tables.read(spark, tier_path).count() == spark.read.parquet(c.raw_users).count()
    assert tables.read(spark, c.path("dim_users")).count() > 0
    stamp = {f: os.path.getmtime(os.path.join(tier_path, f)) for f in os.listdir(tier_path)}

    status = jobs.run_daily(spark, c)
    assert status["fct_events"] == "incremental"
    assert {f: os.path.getmtime(os.path.join(tier_path, f)) for f in os.listdir(tier_path)} == stamp
    results = {r["check"]: r["status"] for r in tables.read(spark, c.path("check_results")).collect()}
    assert all(s in ("pass", "warn") for s in results.values())

    assert "mart_repo_health" in jobs.register_views(spark, c)
    top = spark.sql("SELECT repo_id FROM mart_repo_health WHERE bus_factor_label = 'bus_factor_1'")
    assert top.count() == tables.read(spark, c.path("mart_repo_health")) \
        .filter("bus_factor_label = 'bus_factor_1'").count()


def test_failing_check_stops_the_job(spark, landed, tmp_path):
    """A repeated staged repo snapshot stops the run before anything built from it is replaced;
    a warning does not."""
    c = cfg(landed, str(tmp_path / "out"))
    jobs.run_daily(spark, c)
    kept = {n: tables.location(spark, c.path(n)) for n in ("dim_repos", "mart_repo_health", "mart_pr_velocity")}
    twice = str(tmp_path / "raw_repos")
    raw = spark.read.parquet(c.raw_repos)
    tables.replace_partitions(raw.unionByName(raw.filter("id % 50 = 1")), twice, "ingested_date")
    bad = replace(c, raw_repos=twice)
    with pytest.raises(checks.CheckFailed) as stop:
        jobs.run_daily(spark, bad)
    assert "stg_repos_repo_id_ingested_at_unique" in stop.value.failures
    assert kept == {n: tables.location(spark, c.path(n)) for n in kept}
    rows = {r["check"]: r["status"] for r in tables.read(spark, c.path("check_results")).collect()}
    assert rows["stg_repos_repo_id_ingested_at_unique"] == "fail"
    late = replace(c, now=dt.datetime(2024, 3, 1))        # recency is only a warning
    jobs.run_daily(spark, late)
    rows = {r["check"]: r["status"] for r in tables.read(spark, c.path("check_results")).collect()}
    assert rows["fct_recency_48h"] == "warn"


def test_events_after_the_clock_stop_the_job(spark, landed, tmp_path):
    c = replace(cfg(landed, str(tmp_path / "out")), now=dt.datetime(2024, 1, 15))
    with pytest.raises(checks.CheckFailed):
        jobs.run_daily(spark, c)
    assert not tables.exists(spark, c.path("mart_repo_health"))


def test_arrivals_never_go_back_in_time(spark, landed, tmp_path):
    raw = str(tmp_path / "raw_events")
    events = standins.raw_events(spark, SF["0.001"])
    tables.replace_partitions(events.filter((F.col("dt") < "2024-01-21") & (F.col("dt") != "2024-01-10")), raw, "dt")
    c = replace(cfg(landed, str(tmp_path / "out")), raw_events=raw)
    seen = []

    def record(s, conf):
        seen.append((conf.as_of.isoformat(), conf.days))
        return jobs.run_daily(s, conf)

    ckpt = str(tmp_path / "ckpt")
    assert arrivals.run_on_arrivals(spark, c, ckpt, record) == ["2024-01-21"]
    health = tables.read(spark, c.path("mart_repo_health")).select("repo_id", "repo_age_days").collect()
    # A late file: the run stays at the newest day and replaces the late one alone.
    held = tables.days_in_force(spark, c.path("fct_events"))
    tables.replace_partitions(events.filter(F.col("dt") == "2024-01-10"), raw, "dt")
    assert arrivals.run_on_arrivals(spark, c, ckpt, record) == ["2024-01-21"]
    assert seen[-1] == ("2024-01-21", (dt.date(2024, 1, 10),))
    now = tables.days_in_force(spark, c.path("fct_events"))
    assert {d for d in now if now[d] != held.get(d)} == {"2024-01-10"}
    days = {str(r[0]) for r in tables.read(spark, c.path("fct_events")).select("event_date").distinct().collect()}
    assert "2024-01-10" in days
    assert sorted(health) == sorted(tables.read(spark, c.path("mart_repo_health")).select("repo_id", "repo_age_days").collect())
    assert arrivals.run_on_arrivals(spark, c, ckpt, record) == []


def test_command_line_land_and_daily(spark, landed, tmp_path):
    import json as _json

    from pulse.plans import run as cli
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "repos.json").write_text("\n".join(_json.dumps(
        {"id": 900000 + k, "full_name": f"org/x{k}", "owner": {"id": 1, "login": "u1"}, "fork": False,
         "stargazers_count": 5, "archived": False, "created_at": "2020-01-01T00:00:00Z", "pushed_at": ""})
        for k in range(5)))
    (tmp_path / "targets.csv").write_text("full_name,enabled\norg/x0,true\norg/x1,\norg/x2,true\norg/x3,false\n")
    base = ["--root", str(tmp_path / "out"), "--raw-events", os.path.join(landed, "raw_events"),
            "--raw-repos", str(tmp_path / "raw_repos"), "--raw-users", os.path.join(landed, "raw_users"),
            "--as-of", "2024-01-31"]
    out = cli.main(["land", *base, "--repo-docs", str(docs), "--ingested-at", "2024-01-31 06:00:00",
                    "--targets", str(tmp_path / "targets.csv")],
                   spark)
    assert out == {"repos": 3}
    result = cli.main(["daily", *base, "--now", "2024-01-31T12:00:00"], spark)
    assert result["status"]["fct_events"] == "full" and "marts" in result["seconds"]
    assert tables.read(spark, str(tmp_path / "out" / "mart_repo_health")).count() == 3
