"""Steps of the jobs whose seconds grew faster than they need: what is computed once, and where."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulse import schemas
from pulse.operators import checks, history
from pulse.sources import ingest, standins, tables

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
AT = datetime(2024, 1, 3, 4, 5, 6)


def _events(spark, tmp_path):
    rows = [(i, AT, i % 9, "view", 1.0, f'{{"k": {i % 7}}}') for i in range(25)] + [(20, AT, None, None, None, None)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    return standins.raw_events(spark, str(tmp_path))


def test_event_copies_are_made_last(spark, tmp_path):
    """Every tenth event comes twice, and nothing is computed in the loop over the copies."""
    raw = _events(spark, tmp_path)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("explode(") < plan.index("get_json_object(")
    counts = {r["id"]: r["count"] for r in raw.groupBy("id").count().collect()}
    assert counts == {str(i): {0: 2, 10: 2, 20: 4}.get(i, 1) for i in range(25)}
    assert raw.columns == ["id", "type", "created_at", "actor", "repo", "org", "public", "dt"]


def test_spans_added_as_numbers(spark):
    df = spark.createDataFrame([(AT, 5), (AT, -30), (AT, None), (None, 1)], "t timestamp, n int")
    for unit, micros in (("MINUTE", standins.MINUTE), ("HOUR", standins.HOUR), ("DAY", 24 * standins.HOUR)):
        both = df.select(F.timestamp_add(unit, F.col("n"), F.col("t")).alias("want"),
                         standins._later(F.col("t"), F.col("n"), micros).alias("got")).collect()
        assert [r.got for r in both] == [r.want for r in both]


def test_empty_batch_may_be_allowed(spark, tmp_path):
    """An empty batch is found out by the write itself; rejects are never taken for one."""
    row = (1, None, "u1", "User", False, None, None, None, 0, 0, 0, AT, AT)
    users = spark.createDataFrame([row], schemas.USERS)
    nothing = users.groupBy(*users.columns).count().drop("count").filter(F.col("id") < 0)
    path = f"{tmp_path}/users"
    ingest.land_snapshots(users, path, schemas.USERS_REQUIRED)
    assert ingest.land_snapshots(nothing, path, schemas.USERS_REQUIRED, may_be_empty=True) == 0
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="empty batch"):
        ingest.land_snapshots(nothing, path, schemas.USERS_REQUIRED)
    with pytest.raises(ValueError, match="empty batch"):
        ingest.land_snapshots(users.withColumn("login", F.lit(None).cast("string")), path, schemas.USERS_REQUIRED,
                              may_be_empty=True)


def test_overlap_windows_run_once(spark):
    """What pairs the clusters reads them as they were written, not the windows over the dimension again."""
    rows = [(1, "a", AT, None), (1, "b", datetime(2024, 1, 5), None), (2, "c", AT, None)]
    dim = spark.createDataFrame(rows, "repo_id bigint, dim_repo_id string, valid_from timestamp, valid_to timestamp")
    found = checks.no_overlap(dim, "dim_repos", "repo_id", "dim_repo_id")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.natural_key, r.a_sk, r.b_sk) for r in found.collect()} == {("1", "a", "b"), ("1", "b", "a")}


def _windows(df):
    """Passes over a window in the plan, each with its sort if there is one."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return sum(line.lstrip(" :+-").startswith("Window ") for line in lines)


def test_versions_take_three_passes(spark):
    """Repeats at one time, what changed, and the ends of versions: one pass over the key's window each."""
    rows = [(1, "a", datetime(2024, 1, k)) for k in (1, 2)] + [(1, "b", datetime(2024, 1, 3)), (2, "a", AT)]
    df = spark.createDataFrame(rows, "id bigint, state string, at timestamp")
    made = history.scd2(df, "id", "at", ["state"], "version")
    assert _windows(made) == 3
    assert {(r.id, r.state, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in made.collect()} == {
        (1, "a", 1, 3, False), (1, "b", 3, None, True), (2, "a", 3, None, True)}


def test_sound_versions_are_not_sorted_by_cluster(spark, monkeypatch):
    """Versions alone in their cluster leave before anything is grouped by cluster; the others stay."""
    day = [datetime(2024, 1, k) for k in range(1, 9)]
    rows = [(1, "a", day[0], day[1]), (1, "b", day[1], day[4]), (1, "c", day[2], day[3]), (1, "d", day[3], day[5]), (1, "e", day[5], None),
            (2, "f", day[0], day[1]), (2, "g", day[1], None), (None, "h", day[0], None), (None, "i", day[1], None)]
    dim = spark.createDataFrame(rows, "repo_id bigint, dim_repo_id string, valid_from timestamp, valid_to timestamp")
    plans, checkpoint = [], type(dim).checkpoint
    monkeypatch.setattr(type(dim), "checkpoint", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), checkpoint(df, *a, **k))[1])
    found = checks.no_overlap(dim, "dim_repos", "repo_id", "dim_repo_id")
    assert {(r.a_sk, r.b_sk) for r in found.collect()} == {("b", "c"), ("c", "b"), ("b", "d"), ("d", "b")}
    lines = [line.lstrip(" :+-").split(" ")[0] for line in plans[0].splitlines()]  # the last step first
    windows = [k for k, step in enumerate(lines) if step == "Window"]
    assert len(windows) == 3 and "Filter" in lines[windows[0]:windows[1]]


def test_last_order_of_a_day_counts(spark, tmp_path):
    """One snapshot a customer and day, that of the highest order, without a ranking before the shuffle."""
    orders = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
              " o_orderpriority string")
    early, late = datetime(1995, 1, 2), datetime(1995, 1, 3)
    rows = [(k, c, "F", 100.0 * (k or 0), d, "1-URGENT") for k, c, d in (
        (1, 7, early), (9, 7, early), (None, 7, early), (2, 7, late), (None, 8, early), (3, None, early), (4, None, early))]
    spark.createDataFrame(rows, orders).write.parquet(f"{tmp_path}/orders.parquet")
    raw = standins.raw_repos(spark, str(tmp_path))
    assert "WindowGroupLimit" not in raw._jdf.queryExecution().executedPlan().toString()
    assert sorted(((r.id, r.stargazers_count) for r in raw.collect()), key=repr) == [(7, 36), (7, 8), (8, 0), (None, 16)]


def test_tables_are_written_with_short_dictionaries(spark, tmp_path):
    """A column that hardly repeats leaves its dictionary early, one that repeats keeps it."""
    pq = pytest.importorskip("pyarrow.parquet")
    rows = spark.range(0, 100_000, 1, 1).select(
        F.concat(F.lit("name "), F.col("id")).alias("name"), (F.col("id") % 5).alias("kind"),
        F.lit(AT.date()).alias("dt"))
    tables.replace_partitions(rows, f"{tmp_path}/plain", "dt")
    staged = tables.stage_days(rows, f"{tmp_path}/days", "dt")
    folders = (f"{tmp_path}/plain/dt=2024-01-03", f"{staged.folder}/dt=2024-01-03", tables.stage(rows, f"{tmp_path}/whole"))
    for folder in folders:
        file = next(n for n in tables._names(spark, folder) if n.endswith(".parquet"))
        meta = pq.ParquetFile(f"{folder}/{file}").metadata.row_group(0)
        name, kind = meta.column(0), meta.column(1)
        start = name.dictionary_page_offset
        assert start is None or name.data_page_offset - start <= tables.DICTIONARY_BYTES
        assert kind.has_dictionary_page
