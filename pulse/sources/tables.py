"""Stored tables: versioned replacement, day tables with audited publication, incremental refresh
(M8), expiry (M9), clone (M21), and a file layout by size (S14, S15).

Two kinds of stored table share one rule: writing and publishing are two steps, readers see
only what is published, publishing is the creation of one small file, and nothing that a reader may have
open is deleted or renamed.

*Versions.* A table that is replaced as a whole is a folder of versions, ``{path}/v000001-<id>/``; an
empty marker ``_READY`` makes a version readable, and the newest one counts.

*Days.* A table that is replaced by the day holds writes, ``{path}/write=w000003-<id>/<day column>=<day>/``, and
lists of the days in force, ``{path}/_days/000003.json``: each day and the write that holds it.
Days are written (``stage_days``), can be audited as they would be published (``as_published``), and
come into force together with a new list (``publish``). The tables of one job are published
under a journal, which the next run finishes if this one dies in between (``recover``).

The version or list before the current one is kept for readers that still have it open. One job
writes a table at a time. A plain folder (raw day tables) reads as itself and is replaced by dynamic
partition overwrite.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegralType, LongType, StructField, StructType

from pulse.streaming import windows

#: Rows per output file, whatever their size.
MAX_RECORDS_PER_FILE = 5_000_000
#: Bytes of a Parquet column's dictionary in a file. Columns whose values hardly repeat outgrow it early and are written
#: plainly from there on, which costs less than looking up each value; files stay as large.
DICTIONARY_BYTES = 64 * 1024
#: Bytes of a row where nothing is stored yet.
ROW_BYTES = 64
#: Quantiles kept of a day's cluster key; a day has at most one range more.
QUANTILES = 255
KEY_QUANTILES = StructType([StructField("day", DateType()), StructField("n_rows", LongType()),
                            StructField("cuts", ArrayType(LongType()))])
_READY = "_READY"
_VERSION = re.compile(r"v(\d{6,})-[0-9a-f]{8}")
_WRITE = re.compile(r"write=(w(\d{6,})-[0-9a-f]{8})")
_LIST = re.compile(r"(\d{6,})\.json")


# --- files --------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem for ``path`` (HDFS, object stores, local): PySpark has no
    public wrapper, so the JVM gateway is used for listing, markers and delete."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str, folders: bool | None = None) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p)
                  if folders is None or s.isDirectory() == folders)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _write_file(spark: SparkSession, path: str, text: str = "") -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    if text:
        out.write(bytearray(text.encode()))
    out.close()


def _read_file(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def fingerprints(spark: SparkSession, path: str, partition_col: str) -> dict[str, str]:
    """Day -> digest of the names and sizes of its files in a plain folder of day partitions; Spark names
    every written file anew, so a day that is written again gets another one. No data is read."""
    out = {}
    for day in _values(spark, path, partition_col):
        fs, p = _fs(spark, f"{path}/{partition_col}={day}")
        files = sorted(f"{f.getPath().getName()} {f.getLen()}" for f in fs.listStatus(p))
        out[day] = hashlib.sha256("\n".join(files).encode()).hexdigest()[:16]
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _values(spark: SparkSession, folder: str, partition_col: str) -> list[str]:
    prefix = f"{partition_col}="
    return [n[len(prefix):] for n in _names(spark, folder, folders=True) if n.startswith(prefix)]


# --- versions -----------------------------------------------------------------

def _number(version: str) -> int:
    return int(_VERSION.fullmatch(version)[1])


def _versions(spark: SparkSession, path: str, ready: bool = True) -> list[str]:
    """Version folders of a table, oldest first."""
    found = [n for n in _names(spark, path, folders=True) if _VERSION.fullmatch(n)]
    return sorted((v for v in found if not ready or _exists(spark, f"{path}/{v}/{_READY}")), key=_number)


def _writer(df: DataFrame, fmt: str = "parquet") -> DataFrameWriter:
    """What every stored table is written with."""
    writer = df.write.format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    return writer.option("parquet.dictionary.page.size", DICTIONARY_BYTES) if fmt == "parquet" else writer


def stage(df: DataFrame, path: str, partition_col: str | None = None, fmt: str = "parquet") -> str:
    """Write a new version that readers do not see yet; its folder."""
    spark, path = df.sparkSession, path.rstrip("/")
    numbers = [_number(v) for v in _versions(spark, path, ready=False)]
    folder = f"{path}/v{max(numbers, default=0) + 1:06d}-{uuid.uuid4().hex[:8]}"
    writer = _writer(df, fmt)
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.save(folder)
    return folder


def _publish_version(spark: SparkSession, folder: str) -> None:
    """Make a staged version current. Versions before the last one go, and older ones that were
    never published."""
    path, name = folder.rstrip("/").rsplit("/", 1)
    if not _exists(spark, f"{folder}/{_READY}"):
        _write_file(spark, f"{folder}/{_READY}")
    kept = set(_versions(spark, path)[-2:])
    for old in _versions(spark, path, ready=False):
        if old not in kept and _number(old) < _number(name):
            delete(spark, f"{path}/{old}")


def replace_table(df: DataFrame, path: str, partition_col: str | None = None,
                  fmt: str = "parquet") -> None:
    """Replace the whole table: a new version, published once it is complete."""
    publish(df.sparkSession, stage(df, path, partition_col, fmt))


# --- days ---------------------------------------------------------------------

@dataclass(frozen=True)
class Staged:
    """Days written to a table that readers do not see yet. ``alone``: once published the
    table holds nothing else; ``gone``: days that leave it; ``note``: what is kept with the list of days."""
    path: str
    write: str
    days: tuple[str, ...]
    partition_col: str
    alone: bool = False
    gone: tuple[str, ...] = ()
    note: dict | None = None

    @property
    def folder(self) -> str:
        return f"{self.path}/write={self.write}"


def _lists(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete lists of days, oldest first."""
    names = set(_names(spark, f"{path}/_days", folders=False))
    return sorted(int(m[1]) for n in names if (m := _LIST.fullmatch(n)) and f"{m[1]}.ok" in names)


def _list(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(_read_file(spark, f"{path}/_days/{number:06d}.json"))


def _writes(spark: SparkSession, path: str) -> dict[str, int]:
    return {m[1]: int(m[2]) for n in _names(spark, path, folders=True) if (m := _WRITE.fullmatch(n))}


def days_in_force(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Day -> write that holds it; None if the table is not kept by the day."""
    path = path.rstrip("/")
    numbers = _lists(spark, path)
    return _list(spark, path, numbers[-1])["days"] if numbers else None


def note(spark: SparkSession, path: str) -> dict:
    """What was kept with the list of days in force."""
    path = path.rstrip("/")
    numbers = _lists(spark, path)
    return _list(spark, path, numbers[-1]).get("note") or {} if numbers else {}


def stage_days(df: DataFrame, path: str, partition_col: str, alone: bool = False) -> Staged:
    """Write the days of ``df`` where readers do not see them yet. What is to leave the table with them, or to be noted,
    is added with ``dataclasses.replace``."""
    spark, path = df.sparkSession, path.rstrip("/")
    number = max([0, *_lists(spark, path), *_writes(spark, path).values()]) + 1
    write = f"w{number:06d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/write={write}"
    _writer(df).partitionBy(partition_col).save(folder)
    return Staged(path, write, tuple(_values(spark, folder, partition_col)), partition_col, alone)


def _after(spark: SparkSession, staged: Staged) -> dict[str, str]:
    before = {} if staged.alone else days_in_force(spark, staged.path) or {}
    after = {d: w for d, w in before.items() if d not in staged.gone}
    return dict(sorted({**after, **dict.fromkeys(staged.days, staged.write)}.items()))


def days_after(spark: SparkSession, staged: Staged) -> list[str]:
    """The days in force once ``staged`` is published."""
    return list(_after(spark, staged))


def _put_list(spark: SparkSession, path: str, partition_col: str, days: dict[str, str], number: int,
              kept: dict) -> None:
    name = f"{path}/_days/{number:06d}"
    _write_file(spark, f"{name}.json", json.dumps({"column": partition_col, "days": days, "note": kept}))
    _write_file(spark, f"{name}.ok")  # a list counts once it is whole


def publish(spark: SparkSession, staged: Staged | str) -> None:
    """Bring a staged version, or staged days, into force, all at once. Publishing again changes nothing."""
    if isinstance(staged, str):
        return _publish_version(spark, staged)
    path, column = staged.path, staged.partition_col
    after = _after(spark, staged)
    own = _writes(spark, path).get(staged.write)
    if own is None or after == days_in_force(spark, path):  # without a write: published, and replaced since
        return
    number = max([own, *[n + 1 for n in _lists(spark, path)]])
    _put_list(spark, path, column, after, number, note(spark, path) if staged.note is None else staged.note)
    _clean(spark, path, column, own)


def _clean(spark: SparkSession, path: str, column: str, own: int) -> None:
    """Drop lists before the last two, and what neither of those has in force among the writes up to ``own``."""
    numbers = _lists(spark, path)
    for old in numbers[:-2]:
        delete(spark, f"{path}/_days/{old:06d}.ok")
        delete(spark, f"{path}/_days/{old:06d}.json")
    used = {(w, d) for n in numbers[-2:] for d, w in _list(spark, path, n)["days"].items()}
    for write, number in _writes(spark, path).items():
        folder = f"{path}/write={write}"
        if number > own:
            continue
        if not any(w == write for w, _ in used):
            delete(spark, folder)
            continue
        for day in _values(spark, folder, column):
            if (write, day) not in used:
                delete(spark, f"{folder}/{column}={day}")


def _read_days(spark: SparkSession, path: str, column: str, days: dict[str, str],
               schema: StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    if not days:
        if schema is None:
            raise ValueError(f"{path} holds no day: give its schema to read it as empty")
        return spark.createDataFrame([], schema)
    rows = reader.parquet(*_folders(spark, path, column, days)).drop("write")
    return rows if schema is None else rows.select(*schema.names)


def _folders(spark: SparkSession, path: str, column: str, days: dict[str, str]) -> list[str]:
    """Folders of the days in force: those of whole writes, where all their days are, so that Spark lists few."""
    by_write: dict[str, set[str]] = {}
    for day, write in days.items():
        by_write.setdefault(write, set()).add(day)
    out = []
    for write, held in by_write.items():
        folder = f"{path}/write={write}"
        if held == set(_values(spark, folder, column)):
            out.append(folder)
        else:
            out += [f"{folder}/{column}={d}" for d in sorted(held)]
    return out


def as_published(spark: SparkSession, staged: Staged, schema: StructType | None = None) -> DataFrame:
    """The table as it would read with the staged days in force."""
    return _read_days(spark, staged.path, staged.partition_col, _after(spark, staged), schema)


def staged_rows(spark: SparkSession, staged: Staged, schema: StructType | None = None) -> DataFrame:
    """The staged days alone."""
    return _read_days(spark, staged.path, staged.partition_col, dict.fromkeys(staged.days, staged.write), schema)


def publish_together(spark: SparkSession, root: str, *staged: Staged) -> None:
    """Bring the days of several tables into force. A journal under ``root`` says what is to be published:
    if this run dies in between, ``recover`` publishes the rest."""
    journal = f"{root.rstrip('/')}/_journal/{uuid.uuid4().hex}"
    _write_file(spark, f"{journal}.json", json.dumps([asdict(s) for s in staged]))
    _write_file(spark, f"{journal}.ok")
    _finish(spark, journal, staged)


def _finish(spark: SparkSession, journal: str, staged) -> None:
    for s in staged:
        publish(spark, s)
    delete(spark, f"{journal}.ok")
    delete(spark, f"{journal}.json")


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish what a run that died had begun to publish; journals that were not whole are dropped, since
    nothing of theirs was published. Returns the tables concerned."""
    folder = f"{root.rstrip('/')}/_journal"
    names = _names(spark, folder, folders=False)
    done = []
    for name in names:
        journal = f"{folder}/{name[:-len('.json')]}"
        if not name.endswith(".json"):
            continue
        if f"{name[:-len('.json')]}.ok" not in names:
            delete(spark, f"{journal}.json")
            continue
        staged = [Staged(**{**s, "days": tuple(s["days"]), "gone": tuple(s["gone"])})
                  for s in json.loads(_read_file(spark, f"{journal}.json"))]
        done += [s.path for s in staged]
        _finish(spark, journal, staged)
    return done


# --- reading ------------------------------------------------------------------

def location(spark: SparkSession, path: str) -> str:
    """Folder of the newest rows in force: the current version, or the newest write in force."""
    path = path.rstrip("/")
    days = days_in_force(spark, path)
    if days:
        numbers = _writes(spark, path)
        return f"{path}/write={max(days.values(), key=lambda w: numbers[w])}"
    current = _versions(spark, path)
    return f"{path}/{current[-1]}" if current else path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has something published (or is a plain folder with rows)."""
    path = path.rstrip("/")
    if _lists(spark, path) or _versions(spark, path):
        return True
    return bool(_names(spark, path)) and not _versions(spark, path, ready=False) and not _writes(spark, path)


def read(spark: SparkSession, path: str, schema: StructType | None = None,
         fmt: str = "parquet") -> DataFrame:
    """Read a stored table. With the declared ``schema`` (partition column included), columns
    that were added later read as null in older files, and no footer is read to find out."""
    path = path.rstrip("/")
    numbers = _lists(spark, path)
    if numbers:
        listed = _list(spark, path, numbers[-1])
        return _read_days(spark, path, listed["column"], listed["days"], schema)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location(spark, path))


def partitions(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """Partition values in force (a small file or a directory listing, no data read)."""
    days = days_in_force(spark, path)
    return sorted(days) if days is not None else _values(spark, location(spark, path), partition_col)


# --- layout -------------------------------------------------------------------

def key_quantiles(df: DataFrame, partition_col: str, key: str) -> DataFrame:
    """``(day, n_rows, cuts)``: rows of each day and the quantiles of its ``key``, from a sketch that
    combines before its shuffle. Only the two columns are read."""
    ranks = ", ".join(f"{k}D / {QUANTILES + 1}" for k in range(1, QUANTILES + 1))
    return (df.groupBy(F.col(partition_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.kll_sketch_agg_bigint(F.col(key).cast("long")).alias("_sketch"))
            .select("day", "n_rows", F.expr(f"kll_sketch_get_quantile_bigint(_sketch, array({ranks}))").alias("cuts")))


def _below(cuts: Column, value: Column, inclusive: bool) -> Column:
    """How many of the sorted ``cuts`` are below ``value``, by sixteens and then one by one."""
    def under(part: Column) -> Column:
        return F.size(F.filter(part, lambda c: (c <= value) if inclusive else (c < value)))

    every = 16
    heads = F.transform(F.sequence(F.lit(1), F.ceil(F.size(cuts) / every).cast("int")),
                        lambda k: F.element_at(cuts, (F.least(k * every, F.size(cuts))).cast("int")))
    sixteens = F.when(F.size(cuts) == 0, 0).otherwise(under(heads))
    return F.least(sixteens * every + under(F.slice(cuts, sixteens * every + 1, F.lit(every))), F.size(cuts))


def file_bytes(spark: SparkSession) -> int:
    """Bytes that a file should have: what AQE gives a task."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return max(int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)), 1)


def layout(df: DataFrame, partition_col: str, cluster_by: tuple[str, ...] = (), tiebreak: str | None = None,
           quantiles: DataFrame | None = None, row_bytes: float = ROW_BYTES) -> DataFrame:
    """Spread rows over tasks so that files follow bytes, and sort them within tasks.

    Without ``cluster_by`` rows are rebalanced by day: AQE splits a day's rows by bytes over as many tasks as
    they need and puts small days together, whatever the number of tasks before.

    With it, each day is cut into ranges of the first cluster key, as many as the day's bytes ask for, at the
    stored quantiles of the key (``key_quantiles``). A key that spans several ranges is dealt over them
    by the hash of ``tiebreak``, so a hot key is split. Each range is sorted, so Parquet statistics let
    scans skip files and row groups. Rebalancing by (day, range) splits what is still too large. A key that is no
    integer is cut by its hash.
    """
    if not cluster_by:
        return df.hint("rebalance", partition_col).sortWithinPartitions(partition_col)
    key = F.col(cluster_by[0])
    if not isinstance(df.schema[cluster_by[0]].dataType, IntegralType):
        key = F.xxhash64(key)
    if quantiles is None:
        quantiles = key_quantiles(df.withColumn("_key", key), partition_col, "_key")
    # As many cuts of the stored ones, evenly spaced, as the day has files less one.
    files = F.least(F.greatest(F.ceil(F.col("n_rows") * row_bytes / file_bytes(df.sparkSession)), F.lit(1)), F.lit(QUANTILES + 1))
    picked = F.when(files > 1, F.transform(
        F.sequence(F.lit(1).cast("long"), files - 1),
        lambda k: F.element_at("cuts", F.round(k * (QUANTILES + 1) / files).cast("int")))
    ).otherwise(F.array().cast("array<bigint>"))
    # One row a day in the window, of at most QUANTILES numbers.
    cuts = F.broadcast(quantiles.select(F.col("day").alias("_day"), picked.alias("_cuts")))
    first, last = _below(F.col("_cuts"), key, False), _below(F.col("_cuts"), key, True)
    spread = last - first + 1
    tie = F.pmod(F.xxhash64(tiebreak), spread).cast("int") if tiebreak else F.lit(0)
    ranged = (df.join(cuts, F.col(partition_col).eqNullSafe(F.col("_day")), "left")
              .withColumn("_range", F.coalesce(first + F.when(spread > 1, tie).otherwise(0), F.lit(0))))
    order = [partition_col, "_range", *cluster_by] + ([tiebreak] if tiebreak else [])
    return (ranged.hint("rebalance", partition_col, "_range").sortWithinPartitions(*order)
            .select(*df.columns))


def stored_quantiles(spark: SparkSession, path: str) -> DataFrame | None:
    """The quantiles kept with a clustered table, one row a day."""
    kept = f"{path.rstrip('/')}/_quantiles"
    return read(spark, kept, KEY_QUANTILES) if _versions(spark, kept) else None


def keep_quantiles(spark: SparkSession, path: str, fresh: DataFrame, alone: bool = False) -> DataFrame:
    """Keep the quantiles of newly written days, and those of the other days in force; returns them all."""
    path = path.rstrip("/")
    before = None if alone else stored_quantiles(spark, path)
    if before is not None:
        in_force = list(days_in_force(spark, path) or {})
        both = (fresh.withColumn("_new", F.lit(True)).unionByName(
            before.filter(F.col("day").cast("string").isin(in_force)).withColumn("_new", F.lit(False))))
        newest = F.max_by(F.struct("n_rows", "cuts"), "_new").alias("_kept")
        fresh = both.groupBy("day").agg(newest).select("day", "_kept.*")
    replace_table(fresh.coalesce(1), f"{path}/_quantiles")  # one row a day
    return stored_quantiles(spark, path)


def row_bytes(spark: SparkSession, path: str) -> float:
    """Bytes a row of the stored days, by their files and the rows that their quantiles counted."""
    path = path.rstrip("/")
    kept, days = stored_quantiles(spark, path), days_in_force(spark, path) or {}
    if kept is None or not days:
        return ROW_BYTES
    numbers = _lists(spark, path)
    column = _list(spark, path, numbers[-1])["column"]
    rows = dict(kept.select(F.col("day").cast("string"), "n_rows").collect())  # one row a day
    size = n = 0
    for day in sorted(set(days) & set(rows))[-7:]:  # the newest days say enough
        fs, p = _fs(spark, f"{path}/write={days[day]}/{column}={day}")
        size, n = size + fs.getContentSummary(p).getLength(), n + rows[day]
    return max(size / n, 1.0) if n else ROW_BYTES


# --- refresh, expiry, clone ------------------------------------------------------

def replace_partitions(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet") -> None:
    """Overwrite only the partitions of a plain folder that are present in ``df`` (insert-overwrite)."""
    (_writer(df, fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).save(path))


def stage_clustered(rows: DataFrame, path: str, partition_col: str, cluster_by: tuple[str, ...] = (),
                    tiebreak: str | None = None, alone: bool = False) -> Staged:
    """Stage the days of ``rows`` in the table's layout. A clustered table's quantiles are counted first, from
    two columns, and kept with the table."""
    spark = rows.sparkSession
    quantiles, size = None, ROW_BYTES
    if cluster_by and isinstance(rows.schema[cluster_by[0]].dataType, IntegralType):
        size = row_bytes(spark, path)
        quantiles = keep_quantiles(spark, path, key_quantiles(rows, partition_col, cluster_by[0]), alone)
    return stage_days(layout(rows, partition_col, cluster_by, tiebreak, quantiles, size), path, partition_col, alone)


def stage_refresh(spark: SparkSession, path: str, build: Callable[[date, int], DataFrame], as_of: date,
                  lookback_days: int = windows.LOOKBACK_DAYS, window_days: int = windows.FACT_WINDOW_DAYS,
                  partition_col: str = "event_date", cluster_by: tuple[str, ...] = (),
                  tiebreak: str | None = None, full: bool = False) -> Staged:
    """Recompute the last ``lookback_days`` days and stage just those. A table without any day (its first
    build), and any table if ``full`` is given, is built over the whole ``window_days`` window
    instead. ``build(as_of, days)`` returns the rows with ``partition_col >= as_of - days``; rows older than
    that cutoff are dropped again here, so a staged day is always whole.
    """
    incremental = not full and bool(partitions(spark, path, partition_col))
    window = windows.refresh_window(as_of, incremental, lookback_days, window_days)
    rows = build(as_of, window.days).filter(F.col(partition_col) >= F.lit(window.cutoff))
    return stage_clustered(rows, path, partition_col, cluster_by, tiebreak, alone=not incremental)


def refresh(spark: SparkSession, path: str, build: Callable[[date, int], DataFrame], as_of: date,
            **options) -> str:
    """``stage_refresh`` and publish. Returns ``"incremental"`` or ``"full"``."""
    staged = stage_refresh(spark, path, build, as_of, **options)
    publish(spark, staged)
    return "full" if staged.alone else "incremental"


def expire(spark: SparkSession, path: str, as_of: date, days: int,
           partition_col: str = "event_date") -> list[str]:
    """Drop days older than ``as_of - days`` (the cutoff day is kept).

    They leave the list of days in force, and their files go with the last list that names them; the partition
    folders of a plain folder are deleted. No data is read or rewritten. Returns the dropped partition values.
    """
    path = path.rstrip("/")
    cutoff = windows.expiry_cutoff(as_of, days).isoformat()
    listed = days_in_force(spark, path)
    dropped = [value for value in partitions(spark, path, partition_col) if value < cutoff]
    if not dropped:
        return []
    if listed is None:
        for value in dropped:
            delete(spark, f"{location(spark, path)}/{partition_col}={value}")
    else:
        kept = {d: w for d, w in listed.items() if d >= cutoff}
        _put_list(spark, path, partition_col, kept, _lists(spark, path)[-1] + 1, note(spark, path))
        _clean(spark, path, partition_col, 0)
    return dropped


def clone_table(spark: SparkSession, src: str, dst: str, partition_col: str,
                cluster_by: tuple[str, ...] = (), tiebreak: str | None = None) -> None:
    """Copy a stored table with its partitioning and layout, replacing ``dst``. The quantiles that ``src`` keeps
    are used and kept again, so its rows are read once."""
    rows = read(spark, src)
    kept = stored_quantiles(spark, src) if cluster_by else None
    if kept is None:
        staged = stage_clustered(rows, dst, partition_col, cluster_by, tiebreak, alone=True)
    else:
        size = row_bytes(spark, src)
        quantiles = keep_quantiles(spark, dst, kept, alone=True)
        staged = stage_days(layout(rows, partition_col, cluster_by, tiebreak, quantiles, size), dst, partition_col, alone=True)
    publish(spark, staged)
