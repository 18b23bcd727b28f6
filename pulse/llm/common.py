"""Shared pieces of the training-data operators: table access, lineage cuts,
streaming over sorted runs, exact splitting of hot groups, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pulse
from pulse.session import shared_dir

#: Words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one group that one task compares at most; larger groups are split into cells.
GROUP_LIMIT = 4096

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(pulse.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="pulse-ship-"), "pulse_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("pulse", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there: later
    steps neither recompute it nor depend on the executors that made it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def hash_bucket(n: int, *cols: Column) -> Column:
    """``xxhash64`` of the columns modulo ``n``; nulls hash like any value."""
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def texts(batch: pa.RecordBatch, name: str = "text", step: int = 512) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with the column as Python strings; a null text reads as empty."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part, [t or "" for t in part.column(name).to_pylist()]


def parts(batch: pa.RecordBatch, column: str = "text", size: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each (one row at least), so that what is
    made from texts at once stays small however long they are."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()  # idle workers keep no buffers


def out_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema)


def split_hot_groups(rows: DataFrame, key: list[str], member: Column, limit: int = GROUP_LIMIT) -> DataFrame:
    """Add ``cell_lo`` and ``cell_hi`` so that every pair of rows with an equal
    ``key`` meets in some ``(key, cell_lo, cell_hi)`` and no cell holds more than
    about ``2 * limit`` rows. A group within the limit is the single cell (0, 0).

    A group of ``c`` rows over the limit is dealt into ``n = ceil(c / limit)`` chunks
    by the hash of ``member``; a row of chunk ``i`` goes to the cells of ``i`` with each
    chunk, so no pair is lost and no task gathers the group. ``own_chunk`` is the row's.
    """
    plain = dict(cell_lo=F.lit(0), cell_hi=F.lit(0), own_chunk=F.lit(0))
    hot = cut(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > limit)
              .select(*key, F.ceil(F.col("_size") / limit).cast("int").alias("_chunks")))
    if hot.isEmpty():  # nothing to split: the join below would change no row
        return rows.withColumns(plain)
    dealt = (rows.join(hot, key, "left")
             .withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
             .withColumn("own_chunk", F.pmod(F.xxhash64(member), F.col("_chunks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))))
    return (dealt.withColumn("cell_lo", F.least("own_chunk", "_other"))
            .withColumn("cell_hi", F.greatest("own_chunk", "_other"))
            .drop("_chunks", "_other"))


def sorted_runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``key`` (integer columns): tables of whole groups with
    the groups' start rows (and the row count as the last entry). A group that
    reaches into the next batch is carried over."""
    carry: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if carry is not None:
            now = pa.concat_tables([carry, now])
        if not now.num_rows:
            continue
        starts = _group_starts(now, key)
        last = int(starts[-1])
        if last:
            yield now.slice(0, last), starts
        carry = now.slice(last)
    if carry is not None and carry.num_rows:
        yield carry, np.array([0, carry.num_rows])


def _group_starts(rows: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for name in key:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class LocalSets:
    """Union-find over the members of one group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected graph: rows ``(node, component)``
    for every node of an edge, ``component`` its smallest reachable node.

    Alternates the large-star and small-star steps: every node points its larger
    neighbours, then its smaller ones, at the smallest it knows. Each step is a
    ``min`` aggregate (combined before its shuffle) and a join that AQE can split at a
    hot node. Edges and minima are checkpointed, so a lost executor costs one step
    and the plan does not grow with the number of rounds.
    """
    now = cut(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
              .where("hi > lo").distinct())
    mark = _fingerprint(now)
    while mark[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("v"))
                    .select("u", F.least("u", "v").alias("m")))
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                    .where("hi > lo").distinct())
        least = cut(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = (large.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(least.select("hi", F.col("m").alias("lo"))))
        now = cut(small.distinct())
        before, mark = mark, _fingerprint(now)
        if mark == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table (one small row to the driver)."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")),
                    F.sum(F.xxhash64("lo", "hi").bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)
