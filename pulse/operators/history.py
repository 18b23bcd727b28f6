"""History operators: change-detected Type 2 versions (M11), contributor tiers
as of each snapshot (M10) and the as-of dimension lookup (M20)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions import contributor_tier, is_distinct_from, surrogate_key
from pulse.functions.scalars import CORE_DAYS, CORE_REPOS, NEW_DAYS


def scd2(df: DataFrame, key: str, order_col: str, tracked: list[str], sk_name: str,
         columns: list[str] | None = None, opened: str | None = None, seen: str | None = None) -> DataFrame:
    """Collapse snapshots into Type 2 versions on the ``tracked`` columns.

    A snapshot opens a version when it is the key's first or when any tracked
    column differs (null-safe) from the previous snapshot; only *consecutive*
    equal snapshots collapse, so A -> B -> A gives three versions. Each version
    keeps the Type 1 values of its *last* snapshot, opens at its first
    snapshot's time (``valid_from``) and closes, half-open, at the next
    version's first snapshot (``valid_to``, null while current).

    Of several snapshots of a key at one time the one whose columns hash highest
    counts; the others would be versions without duration.

    Every window is partitioned by the key alone: one shuffle on the key
    and one sort serve them all. The version's last row is found with ``lead``
    instead of a second ranking pass, and its ``valid_to`` is simply the next
    snapshot's time. A key's group holds one row per snapshot, so its size is
    bounded by the number of snapshot days, not by the data volume.

    ``opened`` names a column with the time at which the version of a row was opened before, null for plain
    snapshots; ``seen`` one to add, with the time of each version's last snapshot (see ``scd2_merge``).
    """
    columns = list(columns or [c for c in df.columns if c not in (order_col, opened)])
    every = Window.partitionBy(key).orderBy(order_col, "_tie")
    following = F.lead(order_col).over(every)
    df = (df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_following", following)
          .filter(F.col("_following").isNull() | (F.col("_following") != F.col(order_col)))
          .drop("_tie", "_following"))
    w = Window.partitionBy(key).orderBy(order_col)
    changed = reduce(lambda a, b: a | b,
                     [is_distinct_from(F.lag(c).over(w), F.col(c)) for c in tracked])
    opens = F.lag(order_col).over(w).isNull() | changed
    flagged = df.withColumn("_opens", opens)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.coalesce(opened, order_col) if opened else F.col(order_col)
    versions = (
        flagged
        .withColumns({  # in one step, so that one pass over the window serves them
            "_closes": F.lead("_opens", 1, True).over(w),
            "valid_from": F.max(F.when(F.col("_opens"), start)).over(running),
            "valid_to": F.lead(order_col).over(w)})
        .filter("_closes")
    )
    keep = [c for c in columns if c not in (key, "valid_from", "valid_to")]
    last_seen = [F.col(order_col).alias(seen)] if seen else []
    out = versions.select(key, *keep, "valid_from", "valid_to", *last_seen)
    return out.select(surrogate_key(out, key, "valid_from").alias(sk_name), *[c for c in out.columns if c != seen],
                      F.col("valid_to").isNull().alias("is_current"), *([seen] if seen else []))


def scd2_merge(current: DataFrame, fresh: DataFrame, key: str, order_col: str, tracked: list[str], sk_name: str,
               columns: list[str], seen: str = "seen_at") -> DataFrame:
    """The versions that stand after ``fresh`` snapshots, which are all newer than what their key had shown, meet
    the ``current`` versions: those extended or left as they are, those closed, and those opened.

    A current version takes part as one snapshot, at the time it was last seen, which opened when the version
    did. Closed versions do not change and are not read.
    """
    keep = [c for c in columns if c != key]
    held = current.select(key, *keep, F.col(seen).alias(order_col), F.col("valid_from").alias("_opened"))
    new = fresh.select(key, *keep, order_col, F.lit(None).cast("timestamp").alias("_opened"))
    return scd2(held.unionByName(new), key, order_col, tracked, sk_name, [key, *keep], opened="_opened", seen=seen)


def late_keys(current: DataFrame, fresh: DataFrame, key: str, order_col: str, seen: str = "seen_at") -> DataFrame:
    """Keys with a snapshot that is not newer than what they had shown: it may split a version or join two, which
    only their whole history tells."""
    held = current.select(F.col(key).alias("_key"), F.col(seen).alias("_seen"))
    return (fresh.select(key, order_col).join(held, F.col(key) == F.col("_key"))
            .filter(F.col(order_col) <= F.col("_seen")).select(key).distinct())


def _tier_columns(df: DataFrame, new_days: int, core_repos: int, core_days: int) -> DataFrame:
    return df.select(
        "user_id", "snapshot_at", "snapshot_date", "first_event_at", "distinct_repos",
        contributor_tier("first_event_at", "distinct_repos", "snapshot_date",
                         new_days, core_repos, core_days).alias("contributor_tier"),
    )


def user_snapshot_times(stg_users: DataFrame) -> DataFrame:
    return (stg_users.select("user_id", F.col("ingested_at").alias("snapshot_at")).distinct()
            .withColumn("snapshot_date", F.to_date("snapshot_at")))


def first_touch(fct: DataFrame) -> DataFrame:
    """(actor, repo) -> first event time, from the fact or its daily partials. Partial aggregation collapses each
    actor's events map-side, so even an actor with a third of all events ships
    only one row per repo it touched from each map task."""
    at = "first_at" if "first_at" in fct.columns else "event_at"
    return fct.groupBy("actor_id", "repo_id").agg(F.min(at).alias("first_at"))


def contributor_tiers(stg_users: DataFrame, fct: DataFrame, new_days: int = NEW_DAYS,
                      core_repos: int = CORE_REPOS, core_days: int = CORE_DAYS) -> DataFrame:
    """Tier of each (user, snapshot) from the events at or before the snapshot.

    Only events of users with a snapshot are read on (a semi join below the first
    aggregate), and the fact is read once: it is reduced to first touches, and these are
    laid out with the snapshots on one time line per (user, day). A repo counts as of a
    snapshot exactly when it was first touched at or before it, so the count is a
    running one within the day plus the totals of earlier days. The first
    window is grouped by (user, day), the second holds one row a day and snapshot, so a
    user with a third of all events is spread over days and never gathered whole.
    """
    snaps = user_snapshot_times(stg_users)
    users = stg_users.select(F.col("user_id").alias("actor_id")).distinct()
    touches = first_touch(fct.join(users, "actor_id", "left_semi"))
    line = touches.select(
        F.col("actor_id").alias("user_id"), F.col("first_at").alias("at"), F.to_date("first_at").alias("day"),
        F.lit(0).alias("snap"), F.col("first_at").alias("touch")).unionByName(
        snaps.select("user_id", F.col("snapshot_at").alias("at"), F.col("snapshot_date").alias("day"),
                     F.lit(1).alias("snap"), F.lit(None).cast("timestamp").alias("touch")))
    in_day = Window.partitionBy("user_id", "day").orderBy("at", "snap")  # a touch at the snapshot's time counts
    so_far = in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = (line.withColumns({"n": F.count("touch").over(so_far), "first": F.min("touch").over(so_far),
                               "closes": F.lead("snap").over(in_day).isNull()})
             .filter((F.col("snap") == 1) | F.col("closes")))
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    earlier = Window.partitionBy("user_id").orderBy("number").rangeBetween(Window.unboundedPreceding, -1)
    totals = (marks.withColumn("number", number)
              .withColumns({"n_before": F.sum(F.when(F.col("closes"), F.col("n"))).over(earlier),
                            "first_before": F.min(F.when(F.col("closes"), F.col("first"))).over(earlier)})
              .filter("snap = 1"))
    at_snapshots = totals.select(
        "user_id", F.col("at").alias("snapshot_at"), F.col("day").alias("snapshot_date"),
        F.least("first_before", "first").alias("first_event_at"),
        (F.coalesce("n_before", F.lit(0)) + F.col("n")).cast("bigint").alias("distinct_repos"))
    return _tier_columns(at_snapshots, new_days, core_repos, core_days)


def as_of_join(fact: DataFrame, dim: DataFrame, key: str, ts_col: str, dim_columns: list[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to", prefix: str = "",
               span: str = "hour") -> DataFrame:
    """Left-join each fact row to the dimension version in force at its time:
    ``valid_from <= ts < valid_to`` (``valid_to`` null = open). Versions of a key must not overlap.

    Nothing is joined. Fact rows and versions are laid on one time line per (key, ``span``), each once, and the last
    version before a row is carried forward to it. A span also needs the version that was in force when it began: the
    spans in which a key has rows, read from two columns of the fact and made distinct before any
    shuffle, are laid on one line per key with its versions, which gives one carried-in row each. So no more rows are laid out
    than the fact, the versions, and one for each key and span with rows.

    A line holds the rows of one key in one span, so a key with a third of all rows is spread over
    all spans of its window; the lines of whole keys hold versions and spans only. Rows without key or time
    are spread by their hash and meet no version.
    """
    columns = [c for c in dim_columns if c != key]
    version = F.struct(F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"),
                       *[F.col(c).alias(f"_c{k}") for k, c in enumerate(columns)])
    opens = (dim.filter(F.col(key).isNotNull())
             .select(F.col(key).alias("_k"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version")))
    placed = F.col(key).isNotNull() & F.col(ts_col).isNotNull()
    rows = fact.select(
        F.col(key).alias("_k"), F.date_trunc(span, ts_col).alias("_span"), F.col(ts_col).alias("_at"), F.lit(1).alias("_kind"),
        F.when(placed, F.lit(0)).otherwise(F.pmod(F.xxhash64(*fact.columns), F.lit(4096)).cast("int")).alias("_salt"),
        F.struct(*fact.columns).alias("_row"))
    # The version in force as each span with rows begins.
    begun = (fact.filter(placed).select(F.col(key).alias("_k"), F.date_trunc(span, ts_col).alias("_at")).distinct()
             .select("_k", "_at", F.lit(1).alias("_kind"), F.lit(None).cast(opens.schema["_version"].dataType).alias("_version")))
    by_key = Window.partitionBy("_k").orderBy("_at", "_kind", F.xxhash64("_version"))
    carried = (opens.unionByName(begun)
               .withColumn("_version", F.last("_version", ignorenulls=True).over(
                   by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .filter((F.col("_kind") == 1) & F.col("_version").isNotNull()
                       & (F.col("_version._to").isNull() | (F.col("_version._to") > F.col("_at"))))
               .withColumn("_kind", F.lit(0)))
    versions = (opens.unionByName(carried)
                .withColumn("_span", F.date_trunc(span, "_at")).withColumn("_salt", F.lit(0))
                .withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)))
    line = Window.partitionBy("_k", "_span", "_salt").orderBy("_at", "_kind", F.xxhash64("_version"))
    empty = F.lit(None).cast(opens.schema["_version"].dataType)
    met = (rows.withColumn("_version", empty).unionByName(versions)
           .withColumn("_version", F.last("_version", ignorenulls=True).over(
               line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .filter("_kind = 1"))
    in_force = F.col("_version._to").isNull() | (F.col("_at") < F.col("_version._to"))
    return met.select("_row.*", *[F.when(in_force, F.col(f"_version._c{k}")).alias(prefix + c)
                                  for k, c in enumerate(columns)])
