"""Daily and weekly jobs.

Daily builds everything except the contributor-tier table and what depends on
it (``dim_users``); weekly builds everything. Each step reads the previous
step's *stored* table, so lineage is cut at every table and a lost executor
only re-runs tasks of the current step. Tables live under ``cfg.root``, which
must be shared storage on a cluster.

Everything is written, checked, and only then published. The days of the event tables and of their daily partials are
staged together, the checks look at them as they would be published, and one journal brings them all into
force, so a flawed day leaves every table at its last good state and a run that dies in between is finished by the
next. An error-level failure raises ``CheckFailed`` there and then: what depends on the failing table keeps its last
good version.

What a run reads follows from what is new: the replaced days of the raw tables, the stored partials of the
others, and snapshots of days that were not applied before.
"""

from __future__ import annotations

import threading
import time as clock
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from pulse import schemas
from pulse.operators import checks, declared, dims, facts, history, marts, partials, staging
from pulse.session import shared_dir
from pulse.sources import ingest, tables
from pulse.streaming import windows

FACT_CLUSTER = ("repo_id", "event_type")
RAW_EVENTS = StructType([*schemas.EVENTS.fields, StructField("dt", DateType())])
_DAY = StructField("ingested_date", DateType())
RAW_REPOS = StructType([*schemas.REPOS.fields, _DAY])
RAW_USERS = StructType([*schemas.USERS.fields, _DAY])


@dataclass
class PipelineConfig:
    root: str                         # output tables
    raw_events: str                   # day tables: Parquet partitioned by ``dt``
    raw_repos: str                    # landed repo snapshots (partitioned by ingested_date)
    raw_users: str                    # landed user snapshots
    as_of: date
    tier_params: dict = field(default_factory=dict)   # new_days, core_repos, core_days
    now: datetime | None = None       # clock of the checks; the end of ``as_of`` if not given
    lookback_days: int = windows.LOOKBACK_DAYS
    full: bool = False                # rebuild the event tables over their whole windows
    days: tuple[date, ...] | None = None   # recompute these event days instead of the lookback

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def clock(self) -> datetime:
        return self.now or datetime.combine(self.as_of + timedelta(days=1), time())


@contextmanager
def _step(timings: dict | None, name: str):
    t0 = clock.perf_counter()
    yield
    if timings is not None:
        timings[name] = round(timings.get(name, 0) + clock.perf_counter() - t0, 3)


def land(spark: SparkSession, cfg: PipelineConfig, repo_docs: DataFrame | None,
         user_docs: DataFrame | None, ingested_at, repo_targets: DataFrame | None = None,
         user_targets: DataFrame | None = None) -> dict[str, int]:
    """Land today's snapshot documents (already read with the document schemas). With a tracked
    list (``full_name`` or ``login``, and ``enabled``) only documents of its enabled entries land."""
    out = {}
    if repo_docs is not None:
        if repo_targets is not None:
            repo_docs = ingest.only_tracked(repo_docs, repo_targets, "full_name")
        out["repos"] = ingest.land_repos(spark, repo_docs, ingested_at, cfg.raw_repos,
                                         cfg.raw_repos + "_rejects")
    if user_docs is not None:
        if user_targets is not None:
            user_docs = ingest.only_tracked(user_docs, user_targets, "login")
        out["users"] = ingest.land_users(spark, user_docs, ingested_at, cfg.raw_users,
                                         cfg.raw_users + "_rejects")
    return out


def concurrently(*steps: Callable[[], object]) -> list:
    """Run independent steps as concurrent Spark jobs from driver threads.

    Small models (dimensions, marts) do not fill a cluster on their own;
    submitting them together keeps the executors busy. Errors propagate.
    """
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


class _Run:
    """One run: builds, checks and publishes models, and keeps the check results."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg = spark, cfg
        self.status: dict[str, str] = {}
        self.results: list = []
        self.lock = threading.Lock()

    def read(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.cfg.path(name))

    def raw_repos(self) -> DataFrame:
        return tables.read(self.spark, self.cfg.raw_repos, RAW_REPOS)

    def raw_users(self) -> DataFrame:
        return tables.read(self.spark, self.cfg.raw_users, RAW_USERS)

    def stg_users(self) -> DataFrame:
        return staging.stage_users(self.raw_users())

    def dimension(self, spec: dims.Versioned) -> DataFrame:
        return spec.published(self.read(spec.name))

    def declared(self, model: str) -> list[checks.Check]:
        return declared.declared(model, self.cfg.as_of, self.cfg.clock, self.stg_users)

    def _judge(self, found: list) -> None:
        """Keep check results, whether or not they stop the run."""
        with self.lock:
            self.results += found
        checks.gate(found)

    def check(self, model: str, df: DataFrame) -> None:
        """Check one model."""
        self._judge(checks.summary(self.declared(model), {model: lambda: df}).collect())

    def audit_days(self, model: str, staged: tables.Staged, schema: StructType) -> tables.Staged:
        """Check a day table as it would be published. Row-level checks count the staged days, and days in force that were
        never checked; the counts of the others are noted with the table. Returns ``staged`` with the new note."""
        days = tables.days_after(self.spark, staged)
        before = {} if staged.alone else tables.note(self.spark, staged.path).get("failures", {})
        known = {} if staged.alone else {d: n for d, n in before.items() if d in days and d not in staged.days}
        unchecked = [d for d in days if d not in known]
        whole = tables.as_published(self.spark, staged, schema)
        by_row = [c for c in self.declared(model) if c.bad is not None]
        others = [c for c in self.declared(model) if c.bad is None]
        failures: dict[str, dict[str, int]] = {**known, **{d: {} for d in unchecked}}
        if unchecked:
            new = whole.filter(F.col(staged.partition_col).isin([F.lit(date.fromisoformat(d)) for d in unchecked]))
            for r in checks.day_counts(by_row, new, staged.partition_col).collect():  # a row a day and failing check
                failures[r.day][r.check] = r.failures
        found = []
        for c in by_row:
            n = sum(of_day.get(c.name, 0) for of_day in failures.values())
            found.append(Row(check=c.name, model=model, severity=c.severity, failures=n,
                             status="pass" if not n else "warn" if c.severity == "warn" else "fail"))
        newest = whole.filter(F.col(staged.partition_col) == F.lit(date.fromisoformat(max(days)))) if days else whole
        for df, group in ((newest, [c for c in others if c.newest]), (whole, [c for c in others if not c.newest])):
            if group:
                found += checks.summary(group, {model: lambda df=df: df}).collect()
        self._judge(found)
        return replace(staged, note={"failures": failures})

    def replace(self, name: str, model: str, df: DataFrame) -> None:
        """Write a version, check it, publish it."""
        folder = tables.stage(df, self.cfg.path(name))
        self.check(model, self.spark.read.parquet(folder))
        tables.publish(self.spark, folder)
        self.status[name] = "rebuilt"

    def save_results(self) -> None:
        """The results of this run, and those of every day's last run."""
        if self.results:
            found = self.spark.createDataFrame(self.results, RESULTS)
            tables.replace_table(found, self.cfg.path("check_results"))
            dated = found.coalesce(1).withColumn("as_of", F.lit(self.cfg.as_of))
            tables.publish(self.spark, tables.stage_days(dated, self.cfg.path("check_history"), "as_of"))


#: Columns of stored check results.
RESULTS = "check string, model string, severity string, failures bigint, status string"


def _stage_events(run: _Run) -> tables.Staged:
    """Staged events of the days that this run replaces."""
    spark, cfg, path = run.spark, run.cfg, run.cfg.path("stg_events")
    raw = tables.read(spark, cfg.raw_events, RAW_EVENTS)
    if not cfg.days or cfg.full or not tables.partitions(spark, path, "event_date"):
        return tables.stage_refresh(
            spark, path, lambda a, d: staging.stage_events(raw, a, d), cfg.as_of,
            cfg.lookback_days, windows.STAGING_WINDOW_DAYS, full=cfg.full)
    oldest = windows.expiry_cutoff(cfg.as_of, windows.STAGING_WINDOW_DAYS)
    days = [d for d in cfg.days if d >= oldest]
    stored = tables.read(spark, path, schemas.STORED_EVENTS)
    staged = tables.stage_days(tables.layout(staging.stage_event_days(raw, days), "event_date"), path, "event_date")
    more = staging.outdated_days(stored, tables.staged_rows(spark, staged, schemas.STORED_EVENTS), days)
    if more:
        tables.delete(spark, staged.folder)
        days = sorted({*days, *more})
        staged = tables.stage_days(tables.layout(staging.stage_event_days(raw, days), "event_date"), path, "event_date")
    return replace(staged, gone=tuple(d.isoformat() for d in days if d.isoformat() not in staged.days))


def _stage_fact(run: _Run, events: tables.Staged) -> tables.Staged:
    """Fact days of the staged event days, from the staging table as it would be published."""
    spark, cfg, path = run.spark, run.cfg, run.cfg.path("fct_events")
    options = dict(cluster_by=FACT_CLUSTER, tiebreak="event_id")
    stg = tables.as_published(spark, events, schemas.STORED_EVENTS)
    if events.alone or not cfg.days or not tables.partitions(spark, path, "event_date"):
        return tables.stage_refresh(spark, path, lambda a, d: facts.fct_events(stg, a, d), cfg.as_of, cfg.lookback_days,
                                    windows.FACT_WINDOW_DAYS, full=cfg.full or events.alone, **options)
    oldest = windows.expiry_cutoff(cfg.as_of, windows.FACT_WINDOW_DAYS)
    days = [d for d in map(date.fromisoformat, sorted({*events.days, *events.gone})) if d >= oldest]
    rows = facts.fct_events(stg.filter(F.col("event_date").isin([F.lit(d) for d in days])), cfg.as_of, windows.FACT_WINDOW_DAYS)
    staged = tables.stage_clustered(rows, path, "event_date", **options)
    return replace(staged, gone=tuple(d.isoformat() for d in days if d.isoformat() not in staged.days))


def _stage_partials(run: _Run, fct: tables.Staged) -> list[tables.Staged]:
    """Daily partials of the fact's replaced days, and of days in force that have none yet."""
    spark, out = run.spark, []
    whole = tables.as_published(spark, fct, schemas.STORED_EVENTS)
    for name, build in (("day_activity", partials.day_activity), ("day_prs", partials.day_prs)):
        path = run.cfg.path(name)
        # A day without a row of its own is noted as done.
        done = set() if fct.alone else set(tables.note(spark, path).get("done", ())) - {*fct.days, *fct.gone}
        days = tables.days_after(spark, fct)
        todo = [F.lit(date.fromisoformat(d)) for d in days if d not in done]
        rows = build(whole.filter(F.col("event_date").isin(todo))) if todo else build(whole.limit(0))
        staged = tables.stage_days(tables.layout(rows, "event_date"), path, "event_date", alone=fct.alone)
        stale = tuple(d for d in {*fct.days, *fct.gone} if d not in staged.days)
        out.append(replace(staged, gone=stale, note={"done": days}))
    return out


def _event_tables(run: _Run, timings: dict | None) -> None:
    """Stage, audit and publish the event tables and their partials."""
    spark, cfg = run.spark, run.cfg
    with _step(timings, "stg_events"):
        events = _stage_events(run)
    with _step(timings, "audits"):
        events = run.audit_days("stg_events", events, schemas.STORED_EVENTS)
    with _step(timings, "fct_events"):
        fct = _stage_fact(run, events)
    with _step(timings, "audits"):
        fct = run.audit_days("fct_events", fct, schemas.STORED_EVENTS)
    with _step(timings, "partials"):
        daily = _stage_partials(run, fct)
    tables.publish_together(spark, cfg.root, events, fct, *daily)
    for staged in (events, fct):
        run.status[staged.path.rsplit("/", 1)[-1]] = "full" if staged.alone else "incremental"
    tables.expire(spark, events.path, cfg.as_of, windows.STAGING_EXPIRY_DAYS)
    for staged in (fct, *daily):
        tables.expire(spark, staged.path, cfg.as_of, windows.FACT_EXPIRY_DAYS)


def _merge_dimension(run: _Run, spec: dims.Versioned, model: str, raw: str,
                     snapshots: Callable[[list[str] | None], DataFrame], changed: DataFrame | None = None) -> None:
    """Bring a stored Type 2 dimension up to the landed snapshots; ``snapshots(days)`` are those of landing days, of all
    if None. Usually only the current versions and the new days are read. Keys with a late snapshot, and ``changed`` ones,
    are built from their whole history. A day that was landed again, or is gone, rebuilds the table, since what it
    held before is not known."""
    spark, path = run.spark, run.cfg.path(spec.name)
    landed = tables.fingerprints(spark, raw, "ingested_date")
    applied = tables.note(spark, path).get("applied")
    if applied is None or run.cfg.full or any(landed.get(d) != mark for d, mark in applied.items()):
        rows = spec.stored(spec.versions(snapshots(None)))
        staged = tables.stage_days(rows.hint("rebalance", "closed_on"), path, "closed_on", alone=True)
        how, gone = "rebuilt", ()
    else:
        new = sorted(set(landed) - set(applied))
        stored = tables.read(spark, path)
        current = stored.filter(F.col("closed_on") == F.lit(dims.OPEN_DAY))
        fresh = snapshots(new) if new else snapshots(None).limit(0)
        late = changed
        if new and applied and min(new) <= max(applied):
            out_of_order = spec.late_keys(current, fresh)
            late = out_of_order if late is None else late.unionByName(out_of_order)
        gone = ()
        if late is not None:
            shared_dir(spark)
            late = late.distinct().checkpoint()  # read several times below
            late = None if late.isEmpty() else late
        if late is None:
            if not new:
                run.status[spec.name] = "unchanged"
                return
            rows = spec.stored(spec.merge(current, fresh))
        else:
            def others(df: DataFrame) -> DataFrame:
                return df.join(late, spec.key, "left_anti").select(*df.columns)

            rows = (spec.stored(spec.merge(others(current), others(fresh))).unionByName(
                spec.stored(spec.versions(snapshots(None).join(late, spec.key, "left_semi")))).checkpoint())
            touched = sorted(r[0] for r in stored.join(late, spec.key, "left_semi").select("closed_on").unionByName(
                rows.select("closed_on")).distinct().collect())  # days at most
            kept = stored.filter(F.col("closed_on").isin([F.lit(d) for d in touched if d != dims.OPEN_DAY]))
            rows = rows.unionByName(others(kept))
            gone = tuple(d.isoformat() for d in touched)
        staged = tables.stage_days(rows.hint("rebalance", "closed_on"), path, "closed_on")
        gone = tuple(d for d in gone if d not in staged.days)
        how = "merged"
    staged = replace(staged, gone=gone, note={"applied": landed})
    run.check(model, spec.published(tables.as_published(spark, staged)))
    tables.publish(spark, staged)
    run.status[spec.name] = how


def _landed_days(df: DataFrame, days: list[str] | None) -> DataFrame:
    return df if days is None else df.filter(F.col("ingested_date").isin([F.lit(date.fromisoformat(d)) for d in days]))


def _daily_tables(run: _Run, timings: dict | None) -> None:
    spark, cfg = run.spark, run.cfg
    tables.recover(spark, cfg.root)

    def repo_dims() -> None:
        with _step(timings, "dims"):
            run.check("raw_repos", run.raw_repos())
            run.check("raw_users", run.raw_users())
            run.check("stg_users", run.stg_users())
            run.check("stg_repos", staging.stage_repos(run.raw_repos()))
            _merge_dimension(run, dims.REPOS, "dim_repos", cfg.raw_repos, lambda days: dims.repo_snapshots(
                staging.stage_repos(_landed_days(run.raw_repos(), days))))
            run.replace("dim_languages", "dim_languages", dims.dim_languages(run.dimension(dims.REPOS)))

    concurrently(lambda: _event_tables(run, timings), repo_dims)
    dim_repos = run.dimension(dims.REPOS)
    activity = tables.read(spark, cfg.path("day_activity"), partials.DAY_ACTIVITY)
    prs = tables.read(spark, cfg.path("day_prs"), partials.DAY_PRS)
    days = [date.fromisoformat(d) for d in tables.partitions(spark, cfg.path("fct_events"), "event_date")]
    if days:
        run.replace("dim_dates", "dim_dates", dims.dim_dates(spark, *dims.calendar_span(days[0], days[-1])))
    with _step(timings, "marts"):
        concurrently(
            lambda: run.replace("mart_repo_health", "repo_health", marts.repo_health(dim_repos, activity, cfg.as_of)),
            lambda: run.replace("mart_language_contributor_trends", "language_trends",
                                marts.language_trends(dim_repos, activity, cfg.as_of)),
            lambda: run.replace("mart_pr_velocity", "pr_velocity", marts.pr_velocity(dim_repos, prs, cfg.as_of)))


def _weekly_tables(run: _Run, timings: dict | None) -> None:
    spark, cfg, name = run.spark, run.cfg, "int_user_contributor_tier_snapshots"
    before = run.read(name) if tables.exists(spark, cfg.path(name)) else None
    with _step(timings, "tiers"):
        activity = tables.read(spark, cfg.path("day_activity"), partials.DAY_ACTIVITY)
        run.replace(name, "contributor_tiers",
                    history.contributor_tiers(run.stg_users(), activity, **cfg.tier_params))
    with _step(timings, "dim_users"):
        tiers = run.read(name)
        changed = None
        if before is not None:  # events that came late, or left the window, may change an earlier tier
            same = ["user_id", "snapshot_at"]
            was = before.select(*same, F.col("contributor_tier").alias("_was"))
            changed = tiers.join(was, same).filter(~F.col("_was").eqNullSafe(F.col("contributor_tier"))).select("user_id")
        _merge_dimension(run, dims.USERS, "dim_users", cfg.raw_users, lambda days: dims.user_snapshots(
            staging.stage_users(_landed_days(run.raw_users(), days)), tiers), changed)


def last_run(spark: SparkSession, cfg: PipelineConfig) -> date | None:
    """Day of the newest completed run, None before the first."""
    path = cfg.path("completed_runs")
    return tables.read(spark, path).agg(F.max("as_of")).first()[0] if tables.exists(spark, path) else None


def _run(spark: SparkSession, cfg: PipelineConfig, timings: dict | None, weekly: bool) -> dict[str, str]:
    run = _Run(spark, cfg)
    try:
        _daily_tables(run, timings)
        if weekly:
            _weekly_tables(run, timings)
    finally:
        run.save_results()
    before = last_run(spark, cfg)
    newest = max(before, cfg.as_of) if before else cfg.as_of
    tables.replace_table(spark.createDataFrame([(newest,)], "as_of date"), cfg.path("completed_runs"))
    return run.status


def run_daily(spark: SparkSession, cfg: PipelineConfig, timings: dict | None = None) -> dict[str, str]:
    """Everything but the tier table and ``dim_users``, each model checked.
    ``timings``, when given, receives wall seconds per step."""
    return _run(spark, cfg, timings, weekly=False)


def run_weekly(spark: SparkSession, cfg: PipelineConfig, timings: dict | None = None) -> dict[str, str]:
    """Everything. User tiers, which look back over the whole window, are stored once a week; daily runs leave
    them and ``dim_users`` alone."""
    return _run(spark, cfg, timings, weekly=True)


# Stored model tables under the job root.
MODELS = ("stg_events", "fct_events", "dim_repos", "dim_languages", "dim_dates",
          "int_user_contributor_tier_snapshots", "dim_users", "mart_repo_health",
          "mart_language_contributor_trends", "mart_pr_velocity", "check_results", "check_history")


def register_views(spark: SparkSession, cfg: PipelineConfig) -> list[str]:
    """Expose every built model, the staged snapshots and the dashboard panels as temp views, so
    they can be queried with ``spark.sql``. Returns the names registered."""
    names = []

    def view(name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        names.append(name)

    for name in MODELS:
        if tables.exists(spark, cfg.path(name)):
            view(name, dims.Versioned.published(tables.read(spark, cfg.path(name))))
    run = _Run(spark, cfg)
    if tables.exists(spark, cfg.raw_repos):
        view("stg_repos", staging.stage_repos(run.raw_repos()))
    if tables.exists(spark, cfg.raw_users):
        view("stg_users", run.stg_users())
    for name, mart, panel in (
            ("panel_trends", "mart_language_contributor_trends", marts.panel_trends),
            ("panel_velocity_median", "mart_pr_velocity", marts.panel_velocity_median),
            ("panel_velocity_hist", "mart_pr_velocity", marts.panel_velocity_hist),
            ("panel_bus_factor", "mart_repo_health", marts.panel_bus_factor),
            ("panel_characteristics", "mart_repo_health", marts.panel_characteristics)):
        if mart in names:
            view(name, panel(run.read(mart)))
    return names
