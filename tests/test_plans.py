"""Plan shapes: partition pruning, column pruning, partial window limits, one
shuffle for all SCD2 windows, no pair-producing joins in any registered query."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF
from pulse.plans.queries import QUERIES
from pulse.operators import history, staging
from pulse.plans.inspect import count_shuffles, plan_text, plan_tree
from pulse.sources import standins, tables

AS_OF = dt.date(2024, 1, 31)


@pytest.fixture(scope="module")
def day_tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "events")
    raw = standins.raw_events(spark, SF["0.001"]).withColumn("payload", F.lit("{}"))
    tables.replace_partitions(raw, path, "dt")
    return path


def test_staging_scan_prunes_day_partitions_and_payload(spark, day_tables):
    plan = plan_text(staging.stage_events(spark.read.parquet(day_tables), AS_OF, 3))
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-28" in plan
    read_schema = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read_schema and all("payload" not in line for line in read_schema)


def test_nested_fields_pruned(spark, day_tables):
    plan = plan_text(spark.read.parquet(day_tables).select("actor.id"))
    assert "ReadSchema: struct<actor:struct<id:bigint>>" in plan


def test_top_two_prs_limited_before_shuffle(spark):
    plan = plan_text(entry.queries()["pr_velocity"](spark, SF["0.001"]))
    assert plan.count("WindowGroupLimit") >= 2


def test_scd2_windows_share_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "k bigint, v string, t timestamp")
    assert count_shuffles(history.scd2(df, "k", "t", ["v"], "sk")) == 1


def test_stored_fact_filters_push_to_parquet(spark, scratch):
    from pulse.plans import queries
    i = queries.Inputs(spark, SF["0.001"])
    path = os.path.join(scratch, "fct")
    i.write_fact(path)
    q = tables.read(spark, path).filter((F.col("repo_id") == 7) & (F.col("event_date") >= "2024-01-20"))
    plan = plan_text(q)
    assert "PushedFilters: [IsNotNull(repo_id), EqualTo(repo_id,7)]" in plan
    assert "PartitionFilters: [isnotnull(event_date" in plan


# A job's query returns a stored table; its models are among the other queries.
@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith("job_")))
def test_no_pair_producing_joins_or_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SF["0.001"]))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for python_exec in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "PythonUDF"):
        assert python_exec not in plan


def test_staging_dedup_limited_before_shuffle(spark, day_tables):
    from pulse.plans.inspect import plan_tree
    tree = plan_tree(staging.stage_events(spark.read.parquet(day_tables), AS_OF))
    below = tree.split("Exchange (")[1]
    assert "WindowGroupLimit" in below        # the partial limit runs map-side


def jobs_started(spark, build):
    """Spark jobs that ``build`` starts."""
    group = f"count-{build.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_as_of_join_starts_no_job_and_joins_nothing(spark):
    from pulse.plans import queries
    i = queries.Inputs(spark, SF["0.001"])
    made = []

    def build():
        for span in ("hour", "day"):
            made.append(history.as_of_join(
                i.fct.select("event_id", "repo_id", "event_at"), i.dim_repos, "repo_id", "event_at", ["star_bucket"], span=span))

    i.fct, i.dim_repos  # noqa: B018
    assert jobs_started(spark, build) == 0
    for df in made:
        assert "Join" not in plan_text(df, "simple")
    # The span only changes how work is spread.
    whole = entry.queries()["as_of_join"](spark, SF["0.001"]).select("event_id", "repo_id", "event_at", "star_bucket")
    for df in made:
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_tiers_read_the_fact_once_for_snapshot_users(spark):
    from pulse.plans import queries
    i = queries.Inputs(spark, SF["0.001"])
    fact = spark.createDataFrame(spark.sparkContext.parallelize(i.fct.limit(5).collect()), i.fct.schema)
    users = i.stg_users.filter("user_id = 7")
    tree = plan_text(history.contributor_tiers(users, fact), "simple")
    lines = tree.splitlines()
    assert sum("ExistingRDD" in line and "event_at" in line for line in lines) == 1
    semi = next(k for k, line in enumerate(lines) if "LeftSemi" in line)
    first_aggregate = max(k for k, line in enumerate(lines) if "partial_min(event_at" in line)
    assert semi > first_aggregate        # deeper in the tree: before the aggregate


def test_trends_meet_the_repos_before_the_aggregate(spark):
    lines = plan_text(entry.queries()["language_trends"](spark, SF["0.001"]), "simple").splitlines()
    aggregate = next(k for k, line in enumerate(lines) if "partial_min(event_date" in line)
    join = next(k for k, line in enumerate(lines) if k > aggregate and "Join [repo_id" in line)
    assert join > aggregate


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from pulse.session import shared_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)))
