"""Command line for the jobs (M25), for ``spark-submit``:

    spark-submit pulse/plans/run.py daily  --root R --raw-events E --raw-repos P --raw-users U --as-of 2024-01-31
    spark-submit pulse/plans/run.py weekly ...
    spark-submit pulse/plans/run.py land   ... --repo-docs D1 --user-docs D2 --ingested-at "2024-01-31 06:00:00"

It uses the session ``spark-submit`` provides (cluster settings come from there).
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from pulse import schemas
from pulse.operators.checks import CheckFailed
from pulse.plans import jobs
from pulse.session import configure
from pulse.sources import ingest


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="pulse")
    p.add_argument("job", choices=("land", "daily", "weekly"))
    p.add_argument("--root", required=True, help="output tables (shared storage)")
    p.add_argument("--raw-events", required=True, help="day tables partitioned by dt")
    p.add_argument("--raw-repos", required=True)
    p.add_argument("--raw-users", required=True)
    p.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    p.add_argument("--now", type=datetime.fromisoformat, default=datetime.now(timezone.utc).replace(tzinfo=None),
                   help="clock of the checks, UTC (default: now)")
    p.add_argument("--full", action="store_true", help="rebuild the event tables over their whole windows")
    p.add_argument("--targets", help="CSV of tracked repos (full_name,enabled) for land")
    p.add_argument("--user-targets", help="CSV of tracked users (login,enabled) for land")
    p.add_argument("--repo-docs", help="NDJSON repo documents to land")
    p.add_argument("--user-docs", help="NDJSON user documents to land")
    p.add_argument("--ingested-at", help="run timestamp stamped on landed rows")
    p.add_argument("--new-days", type=int)
    p.add_argument("--core-repos", type=int)
    p.add_argument("--core-days", type=int)
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = configure(spark or SparkSession.builder.appName(f"pulse-{args.job}").getOrCreate())
    tier = {k: v for k, v in (("new_days", args.new_days), ("core_repos", args.core_repos),
                              ("core_days", args.core_days)) if v is not None}
    cfg = jobs.PipelineConfig(root=args.root, raw_events=args.raw_events, raw_repos=args.raw_repos,
                              raw_users=args.raw_users, as_of=args.as_of, tier_params=tier,
                              now=args.now, full=args.full)
    if args.job == "land":
        stamp = args.ingested_at or f"{args.as_of.isoformat()} 00:00:00"
        repo_docs = (ingest.read_documents(spark, args.repo_docs, schemas.REPO_DOCUMENT, traces=True)
                     if args.repo_docs else None)
        user_docs = (ingest.read_documents(spark, args.user_docs, schemas.USER_DOCUMENT, traces=True)
                     if args.user_docs else None)
        repo_targets = (ingest.read_seed_csv(spark, args.targets, "full_name string, enabled boolean")
                        if args.targets else None)
        user_targets = (ingest.read_seed_csv(spark, args.user_targets, "login string, enabled boolean")
                        if args.user_targets else None)
        result = jobs.land(spark, cfg, repo_docs, user_docs, stamp, repo_targets, user_targets)
    else:
        timings: dict = {}
        run = jobs.run_weekly if args.job == "weekly" else jobs.run_daily
        result = {"status": run(spark, cfg, timings), "seconds": timings}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    try:
        main()
    except CheckFailed as failed:
        sys.exit(f"error-level checks failed: {failed}")
