"""Raw inputs derived from the driver's tables.

The driver ships no events, repo or user snapshots of the code-hosting kind, so
these functions derive them -- with Spark, over the *whole* driver tables -- in
the raw shapes the pipeline expects:

* ``raw_events``  <- ``events``: one row per event plus 10 % exact copies (so
  the dedup has work), a few null actors and a few one-person repos; nested
  ``actor``/``repo``/``org`` structs and a ``dt`` day column as in day tables.
* ``raw_repos``   <- ``orders``: one snapshot per (customer, order date),
  squeezed into 2023-12-20..2024-01-30 so as-of lookups see many versions.
* ``raw_users``   <- ``events``: every distinct user (plus three users with no
  events) at five weekly snapshot times.
* ``repo_targets`` <- ``customer``: the tracked-repo list with an optional flag.

The DuckDB oracle (:mod:`pulse.plans.oracle`) derives the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.functions import ts

# Stand-in derivation constants.
SNAPSHOT_TIMES = ("2024-01-03 00:00:00", "2024-01-08 00:00:00", "2024-01-15 00:00:00",
                  "2024-01-22 00:00:00", "2024-01-29 00:00:00")
USERS_WITHOUT_EVENTS = (-1, -2, -3)
REPO_EPOCH = "2023-12-20 00:00:00"       # first repo snapshot time
ORDER_EPOCH = "1995-01-01"               # first order date
MINUTES_PER_ORDER_DAY = 25               # order-date day -> minutes of snapshot time
EVENT_TYPE_MAP = (("purchase", "PullRequestEvent"), ("click", "PushEvent"),
                  ("view", "WatchEvent"), ("signup", "CreateEvent"))
MINUTE, HOUR = 60_000_000, 3_600_000_000  # microseconds
OTHER_EVENT_TYPE = "IssuesEvent"
OWNER_USERS = 5                          # repo owner = custkey mod 5 (users 0..4 exist)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_type(c: Column) -> Column:
    expr = None
    for src, dst in EVENT_TYPE_MAP:
        expr = F.when(c == src, dst) if expr is None else expr.when(c == src, dst)
    return expr.otherwise(OTHER_EVENT_TYPE)


def _later(time: Column, n: Column, micros: int) -> Column:
    """``time`` and ``n`` spans of ``micros``, in plain numbers: the session's zone is UTC, so no calendar is needed."""
    return F.timestamp_micros(F.unix_micros(time) + n * F.lit(micros).cast("bigint"))


def _repo_full_name(repo_id: Column) -> Column:
    return F.concat(F.lit("org/r"), repo_id.cast("string"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with nested structs and a ``dt`` day column (the day table)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    uid, eid = F.col("user_id"), F.col("event_id")
    repo_id = (F.when(uid < 5, uid + 100)
               .when((uid == 5) | ((uid == 6) & (eid % 2 == 0)), F.lit(105).cast("bigint"))
               .otherwise(F.get_json_object("props", "$.k").cast("bigint")))
    rows = ev.select(
        eid.alias("event_id"),
        _event_type(F.col("event_type")).alias("type"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.when(eid % 997 == 0, F.lit(None).cast("bigint")).otherwise(uid).alias("actor_id"),
        repo_id.alias("repo_id"),
    )
    rid, aid = F.col("repo_id"), F.col("actor_id")
    events = rows.select(
        F.col("event_id").cast("string").alias("id"),
        "type",
        "created_at",
        F.struct(aid.alias("id"), F.concat(F.lit("u"), aid.cast("string")).alias("login")).alias("actor"),
        F.struct(rid.alias("id"), _repo_full_name(rid).alias("name")).alias("repo"),
        F.when(rid < 100, F.struct((F.lit(1000) + rid % 10).alias("id"),
                                   F.concat(F.lit("org"), (rid % 10).cast("string")).alias("login"))
               ).alias("org"),
        F.lit(True).alias("public"),
        F.to_date("created_at").alias("dt"),
        (F.col("event_id") % 10 == 0).alias("_twice"),
    )
    # Every tenth event is emitted twice (an exact copy): adds rows, removes
    # none, in the same single scan. The copies come last, so that what is
    # computed for a row is not part of the loop over its copies, which would be
    # too long a method for the JVM to compile.
    copies = F.explode(F.when(F.col("_twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return events.withColumn("_copy", copies).drop("_twice", "_copy")


def raw_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repo snapshot history (17 raw columns), one row per (customer, order date)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    # The last order of a customer's day. Few have a second one, so ranks with their limit before the shuffle
    # would sort everything twice and drop next to nothing.
    latest_last = Window.partitionBy("o_custkey", "o_orderdate").orderBy("o_orderkey")
    o = o.withColumn("_later", F.lead(F.lit(1)).over(latest_last)).filter("_later IS NULL").drop("_later")
    rid = F.col("o_custkey")
    order_day = F.datediff(F.col("o_orderdate").cast("date"), F.lit(ORDER_EPOCH).cast("date"))
    ingested_at = _later(ts(REPO_EPOCH), order_day * MINUTES_PER_ORDER_DAY, MINUTE)
    stars = F.floor(F.col("o_totalprice") / 25).cast("bigint")
    owner = rid % OWNER_USERS
    return o.select(
        rid.alias("id"),
        F.concat(F.lit("R_"), rid.cast("string")).alias("node_id"),
        F.concat(F.lit("r"), rid.cast("string")).alias("name"),
        _repo_full_name(rid).alias("full_name"),
        owner.alias("owner_id"),
        F.concat(F.lit("u"), owner.cast("string")).alias("owner_login"),
        F.concat(F.lit("priority "), F.col("o_orderpriority")).alias("description"),
        (F.col("o_orderpriority") == "1-URGENT").alias("fork"),
        F.when(rid % 7 < 6, F.concat(F.lit("lang_"), (rid % 7).cast("string"))).alias("language"),
        stars.alias("stargazers_count"),
        stars.alias("watchers_count"),
        F.floor(F.col("o_totalprice") / 250).cast("bigint").alias("forks_count"),
        (F.col("o_orderkey") % 50).alias("open_issues_count"),
        (F.col("o_orderstatus") == "F").alias("archived"),
        _later(ts("2015-01-01 00:00:00"), rid % 3000, 24 * HOUR).alias("created_at"),
        F.when(stars >= 1000, _later(ingested_at, -(F.col("o_orderkey") % 24), HOUR)
               ).alias("pushed_at"),
        ingested_at.alias("ingested_at"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User snapshots (13 raw columns): each user at each weekly snapshot time."""
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("id")).distinct()
    extra = spark.range(1).select(F.explode(F.array(*[F.lit(i).cast("bigint") for i in USERS_WITHOUT_EVENTS])).alias("id"))
    ids = ids.unionByName(extra)
    uid = F.col("id")
    is_org = uid % 10 == 0
    snaps = F.explode(F.array(*[ts(t) for t in SNAPSHOT_TIMES]))
    return ids.select(
        uid,
        F.concat(F.lit("U_"), uid.cast("string")).alias("node_id"),
        F.concat(F.lit("u"), uid.cast("string")).alias("login"),
        F.when(is_org, "Organization").otherwise("User").alias("type"),
        F.lit(False).alias("site_admin"),
        F.concat(F.lit("User "), uid.cast("string")).alias("name"),
        F.when(~is_org, F.concat(F.lit("co"), (F.abs(uid) % 7).cast("string"))).alias("company"),
        F.concat(F.lit("city"), (F.abs(uid) % 3).cast("string")).alias("location"),
        (F.abs(uid) % 40).alias("public_repos"),
        (F.abs(uid) % 17).alias("followers"),
        F.when(is_org, F.lit(0).cast("bigint")).otherwise(F.abs(uid) % 5).alias("following"),
        F.timestamp_add("DAY", F.abs(uid), ts("2019-01-01 00:00:00")).alias("created_at"),
        snaps.alias("ingested_at"),
    )


def repo_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked-repo list: (full_name, enabled) where a missing flag is null."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    enabled = (F.when(F.col("c_acctbal") < 0, F.lit(False))
               .when(F.col("c_mktsegment") == "BUILDING", F.lit(True)))
    return c.select(_repo_full_name(F.col("c_custkey")).alias("full_name"), enabled.alias("enabled"))


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def repo_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repo API documents as JSON text with extra keys, per landing day.

    Columns: ``value`` (the document), ``ingested_at`` (the run's time) and
    ``dt``. Unknown keys (private, url, disabled, updated_at, license,
    owner.type) must vanish in projection; ``pushed_at`` is "" when unset.
    """
    r = raw_repos(spark, sf_dir)
    doc = F.struct(
        "id", "node_id", "name", "full_name",
        F.struct(F.col("owner_id").alias("id"), F.col("owner_login").alias("login"),
                 F.lit("User").alias("type")).alias("owner"),
        F.lit(False).alias("private"),
        "description", "fork",
        F.concat(F.lit("https://api.example.invalid/repos/"), F.col("full_name")).alias("url"),
        "language", "stargazers_count", "watchers_count", "forks_count", "open_issues_count",
        "archived", F.lit(False).alias("disabled"),
        _iso(F.col("created_at")).alias("created_at"),
        F.coalesce(_iso(F.col("pushed_at")), F.lit("")).alias("pushed_at"),
        _iso(F.col("ingested_at")).alias("updated_at"),
        F.struct(F.lit("mit").alias("key"), F.lit("MIT License").alias("name")).alias("license"),
    )
    return r.select(F.to_json(doc).alias("value"), "ingested_at",
                    F.to_date("ingested_at").alias("dt"))


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User API documents as JSON text with extra keys (email, public_gists, updated_at)."""
    u = raw_users(spark, sf_dir)
    doc = F.struct(
        "id", "node_id", "login", "type", "site_admin", "name", "company", "location",
        F.concat(F.col("login"), F.lit("@example.invalid")).alias("email"),
        "public_repos", F.lit(3).alias("public_gists"), "followers", "following",
        _iso(F.col("created_at")).alias("created_at"),
        _iso(F.col("ingested_at")).alias("updated_at"),
    )
    return u.select(F.to_json(doc).alias("value"), "ingested_at",
                    F.to_date("ingested_at").alias("dt"))


def malformed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of repo documents, of which some are broken off, hold a value of another type, or lack what is
    required: (``value``, ``dt``)."""
    r = raw_repos(spark, sf_dir)
    kind = F.col("id") % 20
    name = F.when(kind == 3, "").otherwise(F.concat(F.lit('"full_name": "'), F.col("full_name"), F.lit('", ')))
    owner = (F.when(kind == 9, "null").when(kind == 11, '"u1"')
             .otherwise(F.concat(F.lit('{"id": '), F.col("owner_id").cast("string"), F.lit("}"))))
    stars = F.when(kind == 7, '"many"').otherwise(F.col("stargazers_count").cast("string"))
    line = F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(", "), name, F.lit('"owner": '), owner,
                    F.lit(', "stargazers_count": '), stars, F.lit("}"))
    return r.select(F.when(kind == 5, F.substring(line, 1, 25)).otherwise(line).alias("value"),
                    F.to_date("ingested_at").alias("dt"))


# What is wrong with the flawed models, in SQL that both engines read. By
# model: columns replaced where a condition holds, and the condition of rows that come twice.
_EVENT = "CAST(event_id AS BIGINT)"
FLAWS: dict[str, tuple[dict[str, tuple[str, str]], str]] = {
    "raw_repos": ({"id": ("id % 53 = 0", "NULL")}, "FALSE"),
    "raw_users": ({"id": ("id % 47 = 0", "NULL")}, "FALSE"),
    "stg_events": ({"event_type": (f"{_EVENT} % 30 = 7", "'UnknownEvent'"),
                    "event_at": (f"{_EVENT} % 25 = 2", "event_at + INTERVAL 60 DAY")}, f"{_EVENT} % 40 = 1"),
    "fct_events": ({"event_type": (f"{_EVENT} % 30 = 7", "'UnknownEvent'"),
                    "event_id": (f"{_EVENT} % 307 = 3", "NULL")}, f"{_EVENT} % 40 = 1"),
    "stg_repos": ({"owner_id": ("repo_id % 11 = 0", "owner_id + 1000000"),
                   "is_fork": ("repo_id % 17 = 0", "NULL")}, "repo_id % 13 = 0"),
    "stg_users": ({"following": ("user_id % 20 = 0", "CAST(3 AS BIGINT)"),
                   "user_type": ("user_id % 19 = 7", "'Alien'")}, "user_id % 23 = 5"),
    "dim_repos": ({"valid_to": ("repo_id % 7 = 0", "valid_to + INTERVAL 20 DAY"),
                   "star_bucket": ("repo_id % 29 = 1", "'huge'")}, "repo_id % 31 = 2"),
    "dim_users": ({"valid_to": ("user_id % 3 = 0", "NULL"),
                   "contributor_tier": ("user_id % 13 = 1", "'expert'")}, "user_id % 17 = 3"),
    "dim_languages": ({}, "language_name = 'lang_1'"),
    "dim_dates": ({}, "day_of_month = 15"),
    "contributor_tiers": ({"contributor_tier": ("user_id % 13 = 1", "'expert'")}, "user_id % 17 = 3"),
    "repo_health": ({"bus_factor_label": ("repo_id % 37 = 0", "'unknown'")}, "repo_id % 41 = 1"),
    "language_trends": ({}, "language = 'lang_2'"),
    "pr_velocity": ({"days_to_second_pr": ("actor_id % 10 = 2", "NULL")}, "actor_id % 9 = 1"),
}


def flawed(model: str, df: DataFrame) -> DataFrame:
    """``df``, a sound model, with the model's flaws spread over all its rows."""
    changed, twice = FLAWS[model]
    times = F.explode(F.expr(f"sequence(1, CASE WHEN {twice} THEN 2 ELSE 1 END)")).alias("_time")
    return df.select(*[
        F.expr(f"CASE WHEN {changed[c][0]} THEN {changed[c][1]} ELSE `{c}` END").alias(c) if c in changed else F.col(c)
        for c in df.columns], times).drop("_time")
