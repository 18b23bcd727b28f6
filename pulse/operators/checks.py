"""Data-quality checks (M22: D1-D13) and freshness.

A check finds its *offending rows*; none is a pass. Checks that look at one row at a
time carry a condition, and all of a model's are counted by one aggregate, so a model is read
once for them; the others (keys, references, windows) are counted each on its own. The
counts make one summary table, and error-level failures stop a job (``gate``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse.functions import ts
from pulse.session import shared_dir

# Far-future stand-in for an open validity window.
OPEN_END = "9999-12-31 00:00:00"
#: Versions of a chunk: clusters of more are compared chunk by chunk.
CHUNK = 1024


class CheckFailed(Exception):
    """An error-level check found offending rows; ``failures`` maps its name to their number."""

    def __init__(self, failures: dict[str, int]):
        super().__init__("; ".join(f"{name}: {n} rows" for name, n in failures.items()))
        self.failures = failures


@dataclass(frozen=True)
class Check:
    """A named check over one model: either ``bad``, a condition on a row, or ``rows``, a
    function to the offending rows. ``where`` scopes the rows checked (D12); an ``error``
    stops the job, a ``warn`` is only recorded (D11); ``newest``: only the newest day of a day table matters."""
    name: str
    model: str
    rows: Callable[[DataFrame], DataFrame] | None = None
    severity: str = "error"
    where: str | None = None
    bad: Column | None = None
    keep: tuple[str, ...] = ()
    newest: bool = False

    def offending(self, df: DataFrame) -> DataFrame:
        scoped = df.filter(self.where) if self.where else df
        if self.bad is None:
            return self.rows(scoped)
        found = scoped.filter(self.bad)
        return found.select(*self.keep) if self.keep else found

    def status(self, failures: Column) -> Column:
        return F.when(failures == 0, "pass").otherwise("warn" if self.severity == "warn" else "fail")


# --- offending-row builders -------------------------------------------------

def null_in(*cols: str) -> Column:
    """A null in any of ``cols``."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key values (non-null) that occur more than once, with counts."""
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return (keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def outside(col: str, values: tuple) -> Column:
    """D3: a non-null value outside ``values``."""
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (left anti join)."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def recency(df: DataFrame, ts_col: str, now: datetime, max_hours: int) -> DataFrame:
    """One row (newest, age_hours) when the newest ``ts_col`` is older than
    ``max_hours`` before ``now`` -- or when there is no row at all."""
    now_c = ts(now.isoformat(sep=" "))
    newest = df.agg(F.max(ts_col).alias("newest"))
    age = F.timestamp_diff("HOUR", F.col("newest"), now_c)
    too_old = F.col("newest") < F.timestamp_add("HOUR", F.lit(-max_hours), now_c)
    return (newest.select("newest", age.alias("age_hours"))
            .filter(F.col("newest").isNull() | too_old))


def after(ts_col: str, now: datetime) -> Column:
    """A time after ``now``."""
    return F.col(ts_col) > ts(now.isoformat(sep=" "))


def org_follows() -> Column:
    """An organization with a non-zero following count."""
    return (F.col("user_type") == "Organization") & (F.col("following") > 0)


def no_overlap(dim: DataFrame, model: str, key: str, sk: str, chunk: int = CHUNK) -> DataFrame:
    """Every ordered pair of versions of one key whose windows overlap.

    A version belongs to the same cluster as its predecessors while it starts before
    the latest of their ends; versions of different clusters cannot overlap. One window
    over the key marks the clusters, and only clusters of two or more versions are paired, so a
    sound dimension pairs nothing, whatever its number of versions. The clusters, usually none, are written when the
    check is built.

    A cluster is swept in chunks of ``chunk`` versions in order of their start. Two chunks are compared, in a cell of their
    own, if the first one's latest end is after the second one's earliest start, so no task holds more
    than two chunks of a long broken key and far chunks never meet.
    """
    end = F.coalesce(F.col("valid_to"), ts(OPEN_END))
    by_start = Window.partitionBy(key).orderBy("valid_from", sk)
    in_cluster = Window.partitionBy(key, "_cluster")
    before = F.max("_end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    marked = (dim.select(key, sk, "valid_from", end.alias("_end"))
              .withColumn("_opens", F.coalesce(F.col("valid_from") >= before, F.lit(True)))
              .withColumns({  # a version is alone if it opens a cluster and so does the next one
                  "_cluster": F.count(F.when(F.col("_opens"), 1)).over(
                      by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                  "_alone": F.col("_opens") & F.lead("_opens", 1, True).over(by_start)})
              .filter("NOT _alone").drop("_alone")
              .withColumn("_chunk", F.floor((F.row_number().over(in_cluster.orderBy("valid_from", sk)) - 1) / chunk)))
    shared_dir(dim.sparkSession)
    marked = marked.checkpoint()  # read several times below: the windows over the dimension run once
    group = [F.col(key).alias("_key"), "_cluster"]
    chunks = marked.groupBy(*group, "_chunk").agg(F.min("valid_from").alias("_low"), F.max("_end").alias("_high"))
    one, two = (chunks.select("_key", "_cluster", F.col("_chunk").alias(c), F.col("_low").alias(f"{c}_low"),
                              F.col("_high").alias(f"{c}_high")) for c in ("_i", "_j"))
    cells = (one.join(two, ["_key", "_cluster"]).filter("_i <= _j AND _i_high > _j_low")
             .select("_key", "_cluster", "_i", "_j"))

    def side(place: str, name: str) -> DataFrame:
        return marked.select(*group, F.col("_chunk").alias(place), F.col(sk).alias(f"{name}_sk"),
                             F.col("valid_from").alias(f"{name}_from"), F.col("_end").alias(f"{name}_end")
                             ).join(cells, ["_key", "_cluster", place])

    pairs = (side("_i", "a").join(side("_j", "b"), ["_key", "_cluster", "_i", "_j"])
             .filter("a_sk <> b_sk AND a_from < b_end AND b_from < a_end")
             .select(F.col("_key").cast("string").alias("natural_key"), "a_sk", "b_sk", (F.col("_i") < F.col("_j")).alias("_apart")))
    # A pair of two chunks was compared once and counts in both orders.
    both = F.explode(F.when(F.col("_apart"), F.array(F.struct("a_sk", "b_sk"), F.struct(
        F.col("b_sk").alias("a_sk"), F.col("a_sk").alias("b_sk")))).otherwise(F.array(F.struct("a_sk", "b_sk"))))
    return pairs.select("natural_key", both.alias("_pair")).select(
        F.lit(model).alias("model"), "natural_key", "_pair.a_sk", "_pair.b_sk")


def schema_equals(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per column that differs from the expected (name, type) list, with the
    number of rows it concerns."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    diffs = [(n, t, "unexpected") for n, t in got if (n, t) not in want] + \
            [(n, t, "missing") for n, t in want if (n, t) not in got]
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    if not diffs:
        n = n.filter(F.lit(False))
    names = ("column", "type", "problem")
    lines = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, d)]) for d in diffs or [("", "", "")]])
    return n.select("n_rows", F.inline(lines)).select(*names, "n_rows")


# --- running ----------------------------------------------------------------

def _line(check: Check, failures: Column) -> Column:
    return F.struct(F.lit(check.name).alias("check"), F.lit(check.model).alias("model"),
                    F.lit(check.severity).alias("severity"), failures.alias("failures"),
                    check.status(failures).alias("status"))


def summary(checks: list[Check], models: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """One row per check: name, model, severity, failures, status. All row-level checks
    of a model are one aggregate over it; lazy but for ``no_overlap``, so one Spark job when the result is read."""
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        df = models[model]()
        by_row = [c for c in checks if c.model == model and c.bad is not None]
        if by_row:
            counts = df.agg(*[
                F.count(F.when((F.expr(c.where) & c.bad) if c.where else c.bad, 1)).alias(f"n{k}")
                for k, c in enumerate(by_row)])
            lines = F.array(*[_line(c, F.col(f"n{k}")) for k, c in enumerate(by_row)])
            parts.append(counts.select(F.inline(lines)))
        for c in checks:
            if c.model == model and c.bad is None:
                n = c.offending(df).agg(F.count(F.lit(1)).alias("n"))
                parts.append(n.select(F.inline(F.array(_line(c, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts)


def day_counts(checks: list[Check], df: DataFrame, day_col: str) -> DataFrame:
    """``(day, check, failures)`` of row-level checks, where a day has any; one aggregate over ``df``."""
    counts = df.groupBy(F.col(day_col).cast("string").alias("day")).agg(*[
        F.count(F.when((F.expr(c.where) & c.bad) if c.where else c.bad, 1)).alias(f"n{k}") for k, c in enumerate(checks)])
    lines = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"n{k}").alias("failures")) for k, c in enumerate(checks)])
    return counts.select("day", F.inline(lines)).filter("failures > 0")


def gate(results: list) -> None:
    """Raise ``CheckFailed`` if a collected summary row has status ``fail``."""
    failed = {r["check"]: r["failures"] for r in results if r["status"] == "fail"}
    if failed:
        raise CheckFailed(failed)


# --- freshness (M23, D7) ----------------------------------------------------

def freshness(df: DataFrame, source: str, ts_col: str, now: datetime, warn_hours: int,
              error_hours: int, where: str | None = None) -> DataFrame:
    """One row: newest ``ts_col``, its age in whole hours at ``now``, and
    ``pass`` / ``warn`` / ``error`` against the limits. ``where`` bounds the
    scan (e.g. recent day partitions only)."""
    src = df.filter(where) if where else df
    newest = src.agg(F.max(ts_col).alias("max_loaded_at"))
    now_c = ts(now.isoformat(sep=" "))
    age_us = F.unix_micros(now_c) - F.unix_micros(F.col("max_loaded_at"))
    hour_us = 3_600_000_000
    return newest.select(
        F.lit(source).alias("source"), "max_loaded_at",
        F.round(age_us.cast("double") / F.lit(float(hour_us)), 2).alias("age_hours"),
        F.lit(warn_hours).alias("warn_after_hours"), F.lit(error_hours).alias("error_after_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age_us > error_hours * hour_us), "error")
        .when(age_us > warn_hours * hour_us, "warn").otherwise("pass").alias("status"))
