"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Each query builds its whole lineage from the stand-in sources (whole tables, no
row caps) through the library operators, as of ``DEFAULT_AS_OF``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse import DEFAULT_AS_OF, schemas
from pulse.operators import checks, declared, dims, facts, history, marts, staging
from pulse.plans import jobs
from pulse.session import configure, shared_dir
from pulse.sources import ingest, standins, tables
from pulse.streaming import arrivals, windows

# Tier thresholds for the stand-in data. Its events span 30 days,
# so the defaults (30 / 10 / 365) would make every tier "new".
TIER_NEW_DAYS = 5
TIER_CORE_REPOS = 25
TIER_CORE_DAYS = 24

# The check clock, the simulated daily runs and the expiry run.
CHECK_NOW = datetime(2024, 1, 31, 0, 0, 0)
FLAWED_NOW = datetime(2024, 2, 5, 0, 0, 0)
LANDED_AT = "2024-01-31 06:00:00"
COLUMN_ADDED = date(2024, 1, 20)
LATE_DAYS = (date(2024, 1, 20), date(2024, 1, 27))
FIRST_DAILY_RUN = date(2024, 1, 28)
EXPIRY_RUN = date(2024, 4, 15)
WEEKLY_RUN = date(2024, 1, 28)
LATE_DAY = date(2024, 1, 10)
FACT_CLUSTER = jobs.FACT_CLUSTER


class Inputs:
    """Lazily built lineage of one (session, scale-factor directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: date = DEFAULT_AS_OF,
                 checkpointed: bool = False):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.checkpointed = checkpointed
        if checkpointed:
            shared_dir(self.spark)

    def _keep(self, df: DataFrame) -> DataFrame:
        """With ``checkpointed``, write a shared model (one whose own lineage
        shuffles and that several consumers read) once as a Parquet table in the
        shared checkpoint folder and read it back, cutting the lineage."""
        if not self.checkpointed:
            return df
        path = self.scratch("model")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def raw_events(self) -> DataFrame:
        return standins.raw_events(self.spark, self.sf_dir)

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._keep(staging.stage_events(self.raw_events, self.as_of))

    @cached_property
    def fct(self) -> DataFrame:
        return facts.fct_events(self.stg_events, self.as_of)

    @cached_property
    def raw_repos(self) -> DataFrame:
        return standins.raw_repos(self.spark, self.sf_dir)

    @cached_property
    def stg_repos(self) -> DataFrame:
        return self._keep(staging.stage_repos(self.raw_repos))

    @cached_property
    def dim_repos(self) -> DataFrame:
        return self._keep(dims.dim_repos(self.stg_repos))

    @cached_property
    def raw_users(self) -> DataFrame:
        return standins.raw_users(self.spark, self.sf_dir)

    @cached_property
    def stg_users(self) -> DataFrame:
        return self._keep(staging.stage_users(self.raw_users))

    @cached_property
    def tiers(self) -> DataFrame:
        return self._keep(history.contributor_tiers(self.stg_users, self.fct, TIER_NEW_DAYS,
                                                    TIER_CORE_REPOS, TIER_CORE_DAYS))

    @cached_property
    def dim_users(self) -> DataFrame:
        return dims.dim_users(self.stg_users, self.tiers)

    @cached_property
    def repo_health(self) -> DataFrame:
        return marts.repo_health(self.dim_repos, self.fct, self.as_of)

    @cached_property
    def language_trends(self) -> DataFrame:
        return marts.language_trends(self.dim_repos, self.fct, self.as_of)

    @cached_property
    def pr_velocity(self) -> DataFrame:
        return marts.pr_velocity(self.dim_repos, self.fct, self.as_of)

    @cached_property
    def dim_languages(self) -> DataFrame:
        return dims.dim_languages(self.dim_repos)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return dims.dim_dates_covering(self.fct, "event_date")

    def model(self, name: str) -> DataFrame:
        """A model by the name its checks are declared under."""
        return getattr(self, {"fct_events": "fct", "contributor_tiers": "tiers"}.get(name, name))

    # -- stored tables (written under the cluster's shared checkpoint folder) --

    def scratch(self, name: str) -> str:
        return f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def write_fact(self, path: str) -> str:
        """Full build of the stored fact: day partitions, clustered layout."""
        return tables.refresh(self.spark, path, lambda a, d: facts.fct_events(self.stg_events, a, d),
                              self.as_of, cluster_by=FACT_CLUSTER, tiebreak="event_id")


def daily_refreshes(i: Inputs, first_run: date = FIRST_DAILY_RUN) -> DataFrame:
    """The fact as left by daily runs from ``first_run`` to ``as_of``.

    Run day D sees the day tables before D. The first run finds no tables and
    builds the full windows; later runs recompute only the last 3 days of the
    staged events and of the fact and replace those day partitions.
    """
    root = i.scratch("daily")
    stg_path, fct_path = f"{root}/stg_events", f"{root}/fct_events"
    run = first_run
    while run <= i.as_of:
        arrived = i.raw_events.filter(F.col("dt") < F.lit(run))
        tables.refresh(i.spark, stg_path,
                       lambda a, d, src=arrived: staging.stage_events(src, a, d), run,
                       window_days=staging.FULL_LOOKBACK_DAYS)
        staged = tables.read(i.spark, stg_path, schemas.STORED_EVENTS)
        tables.refresh(i.spark, fct_path, lambda a, d, src=staged: facts.fct_events(src, a, d), run,
                       cluster_by=FACT_CLUSTER, tiebreak="event_id")
        run += timedelta(days=1)
    return tables.read(i.spark, fct_path, schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def expired_fact(i: Inputs, run: date = EXPIRY_RUN, days: int = windows.FACT_WINDOW_DAYS) -> DataFrame:
    path = i.scratch("fct")
    i.write_fact(path)
    tables.expire(i.spark, path, run, days)
    return tables.read(i.spark, path, schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def cloned_fact(i: Inputs) -> DataFrame:
    src, dst = i.scratch("fct"), i.scratch("fct_clone")
    i.write_fact(src)
    tables.clone_table(i.spark, src, dst, "event_date", FACT_CLUSTER, "event_id")
    return tables.read(i.spark, dst, schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def projected_repos(i: Inputs) -> DataFrame:
    docs = ingest.parse_documents(standins.repo_documents(i.spark, i.sf_dir), schemas.REPO_DOCUMENT)
    return ingest.project_repos(docs, F.col("ingested_at"))


def projected_users(i: Inputs) -> DataFrame:
    docs = ingest.parse_documents(standins.user_documents(i.spark, i.sf_dir), schemas.USER_DOCUMENT)
    return ingest.project_users(docs, F.col("ingested_at"))


def landed_twice(i: Inputs) -> DataFrame:
    """Land every day's repo snapshots, then land them all again: the table
    must equal a single landing."""
    root = i.scratch("landing")
    for _ in range(2):
        ingest.land_snapshots(projected_repos(i), f"{root}/repos", schemas.REPOS_REQUIRED, "id",
                              f"{root}/repos_rejects")
    return tables.read(i.spark, f"{root}/repos", jobs.RAW_REPOS)


def landed_files(i: Inputs) -> str:
    """Write the repo documents as NDJSON files (those of every twentieth repo without a full name),
    read the files back, keep the tracked repos and land them. Returns the landing's folder."""
    root = i.scratch("files")
    docs = ingest.parse_documents(standins.repo_documents(i.spark, i.sf_dir), schemas.REPO_DOCUMENT)
    nameless = F.when(F.col("id") % 20 != 3, F.col("full_name")).alias("full_name")
    ingest.write_ndjson(docs.select(*[nameless if c == "full_name" else c for c in schemas.REPO_DOCUMENT.names], "dt"),
                        f"{root}/docs")
    read = ingest.read_documents(i.spark, f"{root}/docs", schemas.REPO_DOCUMENT)
    ingest.land_repos(i.spark, read, LANDED_AT, f"{root}/repos", f"{root}/rejects")
    return root


def files_landed(i: Inputs) -> DataFrame:
    targets = standins.repo_targets(i.spark, i.sf_dir)
    landed = tables.read(i.spark, f"{landed_files(i)}/repos", jobs.RAW_REPOS)
    return ingest.only_tracked(landed, targets, "full_name")


def files_rejected(i: Inputs) -> DataFrame:
    rejects = i.spark.read.schema("identifier string, reason string, ingested_date date").json(
        f"{landed_files(i)}/rejects")
    return rejects.select("identifier", "reason", "ingested_date")


def seed_csv(i: Inputs) -> DataFrame:
    """The raw repo snapshots written as a seed CSV and read back in the declared schema."""
    path = i.scratch("seeds")
    i.raw_repos.write.option("header", True).csv(path)
    return ingest.read_seed_csv(i.spark, path, schemas.REPOS)


def added_column(i: Inputs) -> DataFrame:
    """Day partitions written before and after a column was added, read in the declared schema."""
    path = i.scratch("added")
    late = F.col("event_date") >= F.lit(COLUMN_ADDED)
    tables.replace_partitions(i.stg_events.filter(~late).drop("org_login"), path, "event_date")
    tables.replace_partitions(i.stg_events.filter(late), path, "event_date")
    return tables.read(i.spark, path, schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def column_contract(i: Inputs) -> DataFrame:
    """Columns in which raw repos with one column missing and one too many break their contract."""
    broken = i.raw_repos.withColumn("stars", F.col("stargazers_count")).drop("stargazers_count")
    return checks.schema_equals(broken, schemas.REPOS)


def late_rows(i: Inputs) -> DataFrame:
    """Two days that arrive late: the next run's lookback covers one of them, and the other
    stays missing until a full rebuild."""
    missed, caught = LATE_DAYS
    on_time = i.raw_events.filter(~F.col("dt").isin(missed, caught))
    path = i.scratch("late")
    for source, run in ((on_time, caught + timedelta(days=2)), (i.raw_events, caught + timedelta(days=3))):
        tables.refresh(i.spark, path, lambda a, d, src=source: facts.fct_events(
            staging.stage_events(src, a, staging.FULL_LOOKBACK_DAYS), a, d), run,
            cluster_by=FACT_CLUSTER, tiebreak="event_id")
    return tables.read(i.spark, path, schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def weekly_job(i: Inputs, name: str) -> DataFrame:
    """A stored table after the weekly job over landed raw tables, with all checks passed."""
    root = i.scratch("job")
    tables.replace_partitions(i.raw_events, f"{root}/raw_events", "dt")
    ingest.land_snapshots(i.raw_repos, f"{root}/raw_repos", schemas.REPOS_REQUIRED)
    ingest.land_snapshots(i.raw_users, f"{root}/raw_users", schemas.USERS_REQUIRED)
    cfg = jobs.PipelineConfig(
        root=f"{root}/out", raw_events=f"{root}/raw_events", raw_repos=f"{root}/raw_repos",
        raw_users=f"{root}/raw_users", as_of=i.as_of, now=CHECK_NOW,
        tier_params=dict(new_days=TIER_NEW_DAYS, core_repos=TIER_CORE_REPOS, core_days=TIER_CORE_DAYS))
    jobs.run_weekly(i.spark, cfg)
    return dims.Versioned.published(tables.read(i.spark, cfg.path(name)))


def _job(i: Inputs, root: str, as_of: date, **options) -> jobs.PipelineConfig:
    return jobs.PipelineConfig(
        root=f"{root}/out", raw_events=f"{root}/raw_events", raw_repos=f"{root}/raw_repos",
        raw_users=f"{root}/raw_users", as_of=as_of, **options,
        tier_params=dict(new_days=TIER_NEW_DAYS, core_repos=TIER_CORE_REPOS, core_days=TIER_CORE_DAYS))


def _arrive(i: Inputs, root: str, events: Column | None, snapshots: Column | None) -> None:
    """Land the raw events and snapshots of some days (a condition on ``day``)."""
    steps = []
    if events is not None:
        arrived = i.raw_events.withColumn("day", F.col("dt")).filter(events).drop("day")
        steps.append(lambda: tables.replace_partitions(arrived, f"{root}/raw_events", "dt"))
    if snapshots is not None:
        for raw, name, required in ((i.raw_repos, "raw_repos", schemas.REPOS_REQUIRED), (i.raw_users, "raw_users", schemas.USERS_REQUIRED)):
            some = raw.withColumn("day", F.to_date("ingested_at")).filter(snapshots).drop("day")
            steps.append(lambda some=some, name=name, required=required: ingest.land_snapshots(
                some, f"{root}/{name}", required, may_be_empty=True))
    jobs.concurrently(*steps)


def daily_after_weekly(i: Inputs) -> jobs.PipelineConfig:
    """A weekly run, then a daily one over the days that came since: the event days are replaced, their partials
    feed the marts, and the repo versions are merged from the new snapshots."""
    root, day = i.scratch("job"), F.col("day")
    _arrive(i, root, day < F.lit(WEEKLY_RUN), day < F.lit(WEEKLY_RUN))
    jobs.run_weekly(i.spark, _job(i, root, WEEKLY_RUN))
    _arrive(i, root, day >= F.lit(WEEKLY_RUN), day >= F.lit(WEEKLY_RUN))
    cfg = _job(i, root, i.as_of)
    jobs.run_daily(i.spark, cfg)
    return cfg


def late_after_weekly(i: Inputs) -> jobs.PipelineConfig:
    """A weekly run before one day's events and snapshots came, then a weekly run over that day and the new ones: the
    late events change earlier tiers, the late snapshots split and join versions."""
    root, day = i.scratch("job"), F.col("day")
    on_time = (day < F.lit(WEEKLY_RUN)) & (day != F.lit(LATE_DAY))
    _arrive(i, root, on_time, on_time)
    jobs.run_weekly(i.spark, _job(i, root, WEEKLY_RUN))
    _arrive(i, root, ~on_time, ~on_time)
    new = [WEEKLY_RUN + timedelta(days=k) for k in range((i.as_of - WEEKLY_RUN).days + 1)]
    cfg = _job(i, root, i.as_of, days=(LATE_DAY, *new))
    jobs.run_weekly(i.spark, cfg)
    return cfg


def stored(scenario: Callable[[Inputs], jobs.PipelineConfig], name: str) -> Callable[[Inputs], DataFrame]:
    """A stored table as the jobs of ``scenario`` leave it."""
    def build(i: Inputs) -> DataFrame:
        return dims.Versioned.published(tables.read(i.spark, scenario(i).path(name)))
    build.__doc__ = scenario.__doc__
    return build


def flawed_day(i: Inputs) -> DataFrame:
    """The stored fact after a daily run that met event days without ids: the run stops before anything of them is
    published, so the fact is as the weekly run left it."""
    root, day = i.scratch("job"), F.col("day")
    _arrive(i, root, day < F.lit(WEEKLY_RUN), day == day)
    jobs.run_weekly(i.spark, _job(i, root, WEEKLY_RUN))
    nameless = i.raw_events.filter(F.col("dt") >= F.lit(WEEKLY_RUN)).withColumn(
        "id", F.when(F.col("actor.id") % 3 > 0, F.col("id")))
    tables.replace_partitions(nameless, f"{root}/raw_events", "dt")
    cfg = _job(i, root, i.as_of)
    try:
        jobs.run_daily(i.spark, cfg)
    except checks.CheckFailed:
        pass
    return tables.read(i.spark, cfg.path("fct_events"), schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def arrivals_fact(i: Inputs) -> DataFrame:
    """The fact after two runs on arrivals, the second of them for the file of one day that came three weeks late."""
    root, day = i.scratch("job"), F.col("day")
    _arrive(i, root, day != F.lit(LATE_DAY), day == day)
    cfg, seen = _job(i, root, i.as_of), f"{root}/seen"
    arrivals.run_on_arrivals(i.spark, cfg, seen)
    _arrive(i, root, day == F.lit(LATE_DAY), None)
    arrivals.run_on_arrivals(i.spark, cfg, seen)
    return tables.read(i.spark, cfg.path("fct_events"), schemas.STORED_EVENTS).select(*staging.EVENT_COLUMNS)


def views_sql(i: Inputs) -> DataFrame:
    """SQL over the views of a weekly job's tables."""
    root = i.scratch("job")
    _arrive(i, root, F.col("day") == F.col("day"), F.col("day") == F.col("day"))
    cfg = _job(i, root, i.as_of)
    jobs.run_weekly(i.spark, cfg)
    jobs.register_views(i.spark, cfg)
    return i.spark.sql("""
        SELECT l.language_name, d.star_bucket, h.bus_factor_label, count(*) AS repos, sum(h.events_90d) AS events
        FROM mart_repo_health h
        JOIN dim_repos d ON d.repo_id = h.repo_id AND d.is_current
        JOIN dim_languages l ON l.language_name = h.primary_language
        GROUP BY l.language_name, d.star_bucket, h.bus_factor_label""")


def malformed_landed(i: Inputs) -> DataFrame:
    """Rejects of document files with broken lines, wrong types and missing parents: line, file's day and reason."""
    root = i.scratch("files")
    standins.malformed_documents(i.spark, i.sf_dir).write.partitionBy("dt").text(f"{root}/docs")
    read = ingest.read_documents(i.spark, f"{root}/docs", schemas.REPO_DOCUMENT, traces=True)
    ingest.land_repos(i.spark, read, LANDED_AT, f"{root}/repos", f"{root}/rejects")
    rejects = i.spark.read.schema("identifier string, reason string, line string, file string, ingested_date date").json(
        f"{root}/rejects")
    return rejects.select("identifier", "reason", "line", F.to_date(F.regexp_extract("file", "dt=([0-9-]+)/", 1)).alias("file_day"),
                          "ingested_date")


def freshness_report(i: Inputs) -> DataFrame:
    recent = F.col("dt") >= F.date_sub(F.lit(i.as_of), 2)
    return (checks.freshness(i.raw_events.filter(recent), "raw.events", "created_at",
                             CHECK_NOW, 48, 72)
            .unionByName(checks.freshness(i.raw_repos, "raw.repos", "ingested_at",
                                          CHECK_NOW, 25, 48))
            .unionByName(checks.freshness(i.raw_users, "raw.users", "ingested_at",
                                          CHECK_NOW, 25, 48)))


def declared_checks(i: Inputs, now: datetime) -> list[checks.Check]:
    return [c for model in declared.MODELS for c in declared.declared(model, i.as_of, now, lambda: i.stg_users)]


def flawed_check(*names: str) -> Callable[[Inputs], DataFrame]:
    """Offending rows of declared checks over flawed models (sound ones have none to find)."""
    def build(i: Inputs) -> DataFrame:
        picked = [c for c in declared_checks(i, FLAWED_NOW) if c.name in names]
        return reduce(DataFrame.unionByName, [
            c.offending(standins.flawed(c.model, i.model(c.model))) for c in picked])
    return build


def _written(i: Inputs) -> None:
    """Write the shared models, independent ones concurrently."""
    with ThreadPoolExecutor(max_workers=3) as pool:
        for f in [pool.submit(lambda name=n: getattr(i, name)) for n in ("stg_events", "dim_repos", "stg_users")]:
            f.result()
    i.tiers  # noqa: B018  (builds and writes the tier model)


def all_checks(i: Inputs) -> DataFrame:
    _written(i)
    return checks.summary(declared_checks(i, CHECK_NOW), {m: lambda m=m: i.model(m) for m in declared.MODELS})


def all_checks_flawed(i: Inputs) -> DataFrame:
    _written(i)
    return checks.summary(declared_checks(i, FLAWED_NOW), {
        m: lambda m=m: standins.flawed(m, i.model(m)) for m in declared.MODELS})


Query = Callable[[SparkSession, str], DataFrame]


def _q(build: Callable[[Inputs], DataFrame], checkpointed: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Inputs(spark, sf_dir, checkpointed=checkpointed))
    run.__doc__ = build.__doc__
    return run


QUERIES: dict[str, Query] = {
    "stg_events": _q(lambda i: i.stg_events),
    "fct_events": _q(lambda i: i.fct),
    "stg_repos": _q(lambda i: i.stg_repos),
    "stg_users": _q(lambda i: i.stg_users),
    "latest_snapshot": _q(lambda i: staging.latest_snapshot(i.stg_repos, "repo_id")),
    "dim_repos": _q(lambda i: i.dim_repos),
    "scd2_generic": _q(lambda i: history.scd2(
        i.stg_repos.select("repo_id", "repo_full_name", "is_fork", "ingested_at"),
        "repo_id", "ingested_at", ["is_fork"], "version_id")),
    "contributor_tiers": _q(lambda i: i.tiers),
    "dim_users": _q(lambda i: i.dim_users),
    "dim_languages": _q(lambda i: i.dim_languages),
    "dim_dates": _q(lambda i: i.dim_dates),
    "repo_health": _q(lambda i: i.repo_health),
    "language_trends": _q(lambda i: i.language_trends),
    "pr_velocity": _q(lambda i: i.pr_velocity),
    "panel_trends": _q(lambda i: marts.panel_trends(i.language_trends)),
    "panel_velocity_median": _q(lambda i: marts.panel_velocity_median(i.pr_velocity)),
    "panel_velocity_hist": _q(lambda i: marts.panel_velocity_hist(i.pr_velocity)),
    "panel_bus_factor": _q(lambda i: marts.panel_bus_factor(i.repo_health)),
    "panel_characteristics": _q(lambda i: marts.panel_characteristics(i.repo_health)),
    "as_of_join": _q(lambda i: history.as_of_join(
        i.fct.select("event_id", "repo_id", "event_at"), i.dim_repos, "repo_id", "event_at",
        ["dim_repo_id", "star_bucket", "is_archived", "is_current"])),
    "project_repos": _q(projected_repos),
    "project_users": _q(projected_users),
    "land_idempotent": _q(landed_twice),
    "fct_incremental": _q(daily_refreshes),
    "fct_expired": _q(expired_fact),
    "clone_table": _q(cloned_fact),
    "tracked_enabled": _q(lambda i: ingest.tracked(standins.repo_targets(i.spark, i.sf_dir))),
    "freshness": _q(freshness_report),
    "land_files": _q(files_landed),
    "land_rejects": _q(files_rejected),
    "seed_csv": _q(seed_csv),
    "added_column": _q(added_column),
    "column_contract": _q(column_contract),
    "late_rows": _q(late_rows),
    "job_weekly_health": _q(lambda i: weekly_job(i, "mart_repo_health")),
    "job_weekly_users": _q(lambda i: weekly_job(i, "dim_users")),
    "job_weekly_checks": _q(lambda i: weekly_job(i, "check_results")),
    "job_daily_health": _q(stored(daily_after_weekly, "mart_repo_health")),
    "job_daily_trends": _q(stored(daily_after_weekly, "mart_language_contributor_trends")),
    "job_daily_velocity": _q(stored(daily_after_weekly, "mart_pr_velocity")),
    "job_late_repos": _q(stored(late_after_weekly, "dim_repos")),
    "job_late_users": _q(stored(late_after_weekly, "dim_users")),
    "job_late_tiers": _q(stored(late_after_weekly, "int_user_contributor_tier_snapshots")),
    "job_flawed_day": _q(flawed_day),
    "job_arrivals": _q(arrivals_fact),
    "job_views": _q(views_sql),
    "land_malformed": _q(malformed_landed),
    # Many checks over fourteen models: the shared, shuffled ones are written once and read back.
    "checks_summary": _q(all_checks, checkpointed=True),
    "checks_summary_flawed": _q(all_checks_flawed, checkpointed=True),
    "check_raw_event_id_unique": _q(lambda i: checks.unique(i.raw_events, "id")),
    "check_stg_event_keys_not_null": _q(lambda i: i.stg_events.filter(checks.null_in(
        "event_id", "event_type", "event_at", "event_date", "actor_id", "repo_id"))),
    "check_fct_event_id_unique_7d": _q(flawed_check("fct_events_event_id_unique_7d")),
    "check_fct_event_type_accepted": _q(flawed_check("fct_events_event_type_accepted")),
    "check_repo_owner_is_user": _q(flawed_check("repo_owner_is_user")),
    "check_repo_snapshot_grain": _q(flawed_check("stg_repos_repo_id_ingested_at_unique")),
    "check_fct_recency_48h": _q(flawed_check("fct_recency_48h")),
    "check_no_future_events": _q(flawed_check("no_future_events")),
    "check_orgs_dont_follow": _q(flawed_check("orgs_dont_follow")),
    "check_scd2_no_overlap": _q(flawed_check("dim_repos_no_overlap", "dim_users_no_overlap")),
}
