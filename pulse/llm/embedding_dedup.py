"""Near-duplicate embeddings by random-hyperplane sign hashing.

Equal vectors are one node with a count. A node's sign bits against random hyperplanes
are cut into tables of ``bits`` bits; nodes with equal bits in a table meet in that
bucket, where their cosines are computed exactly. The bits a table grow with the
logarithm of the number of nodes, so buckets keep their size, and the tables are as
many as give a pair right at the threshold ``RECALL`` to meet in one of them at least.

A pair is counted in the first table where it meets only, which a bucket knows from the signs of its linked members,
made again from their vectors. So counts add up over
buckets and no pair is emitted: a bucket yields a number of links for each member and enough
edges to connect what it connects. Buckets over the group limit are split into cells.

What travels is each vector once a table. Fuller buckets need fewer bits and so fewer tables, and cost products of
matrices within a task instead; ``BUCKET_ROWS`` weighs the two.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common

THRESHOLD = 0.9
RECALL = 0.995
BUCKET_ROWS = 2048
MIN_BITS = 4
SEED = 8191


def plan(nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits a table, tables) for so many nodes."""
    bits = max(MIN_BITS, math.ceil(math.log2(max(nodes, 1) / BUCKET_ROWS)) if nodes > BUCKET_ROWS else MIN_BITS)
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _planes(dims: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims]).normal(size=(dims, bits * tables))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by their largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _marks(unit: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    tables = planes.shape[1] // bits
    return ((unit @ planes) > 0).reshape(len(unit), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _signatures(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Each node once per table: ``(tab, bucket, node, n, x)``; ``x`` is its vector as doubles, or
    as floats where these hold it exactly."""
    schema = pa.schema([("tab", pa.int32()), ("bucket", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
                        ("x", pa.binary())])

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.diff(batch.column("x").offsets.to_numpy())
            for dims in np.unique(sizes).tolist():  # vectors of other lengths never link: hash them apart
                part = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                x = _matrix(part.column("x"))
                if dims not in planes:
                    planes[dims] = _planes(dims, bits, tables)
                for at in range(0, len(x), 1024):
                    some = x[at: at + 1024]
                    signs = _marks(_unit(some), planes[dims], bits)
                    node = part.column("node").to_numpy()[at: at + 1024]
                    n = part.column("n").to_numpy()[at: at + 1024]
                    small = some.astype(np.float32)
                    exact = (small == some).all(axis=1).tolist()
                    rows = [(small[k] if fits else some[k]).tobytes() for k, fits in enumerate(exact)]
                    for t in range(tables):
                        yield common.out_batch(schema, np.full(len(some), t, np.int32),
                                               signs[:, t] + (np.int64(dims) << np.int64(32)), node, n, rows)

    return nodes.mapInArrow(run, "tab int, bucket long, node long, n long, x binary")


_ROWS_AT_ONCE, _PAIRS_AT_ONCE = 1024, 1 << 14


def _cell_links(unit, marks_of, table, weight, own, threshold):
    """(links added to each member, spanning edges) of one cell. ``marks_of`` gives the buckets of members in the tables
    before this one. ``own``: each member's chunk, or None where all pairs count; else only pairs of different chunks do."""
    m, dims = unit.shape
    rough = unit.astype(np.float32)  # finds candidates; the error of a product of floats is far below the margin
    margin = np.float32(threshold - 1e-6 - 2.0**-22 * dims)
    marks = np.zeros((m, table), dtype=np.int64)
    marked = np.zeros(m, dtype=bool)
    links = np.zeros(m, dtype=np.int64)
    sets = common.LocalSets(m)
    edges: list[tuple[int, int]] = []
    for at in range(0, m, _ROWS_AT_ONCE):
        block = slice(at, at + _ROWS_AT_ONCE)
        i, j = np.nonzero(rough[block] @ rough[at:].T >= margin)
        i, j = i + at, j + at
        keep = i < j
        if own is not None:
            keep &= own[i] != own[j]
        i, j = i[keep], j[keep]
        if len(i):
            exact = [np.einsum("ij,ij->i", unit[i[k: k + _PAIRS_AT_ONCE]], unit[j[k: k + _PAIRS_AT_ONCE]]) >= threshold
                     for k in range(0, len(i), _PAIRS_AT_ONCE)]
            keep = np.concatenate(exact)
            i, j = i[keep], j[keep]
        new = np.unique(np.concatenate([i, j]))
        new = new[~marked[new]]
        if table and len(new):
            marks[new], marked[new] = marks_of(unit[new])[:, :table], True
        for part in range(0, len(i), 1 << 16):
            a, b = i[part: part + (1 << 16)], j[part: part + (1 << 16)]
            first = ~(marks[a] == marks[b]).any(axis=1)  # else counted in an earlier table
            a, b = a[first], b[first]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            for x, y in zip(a.tolist(), b.tolist()):
                p, q = sets.find(x), sets.find(y)
                if p != q:
                    sets.union(p, q)
                    edges.append((x, y))
    return links, edges


def _links(cells: DataFrame, threshold: float, bits: int, tables: int) -> DataFrame:
    """Rows ``(node, other, links)``: links to add to ``node`` (``other`` null), or an edge."""
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])
    key = ["tab", "bucket", "cell_lo", "cell_hi"]

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for rows, starts in common.sorted_runs(batches, key):
            if starts[-1] != rows.num_rows:
                starts = np.append(starts, rows.num_rows)
            node = rows.column("node").to_numpy()
            weight = rows.column("n").to_numpy()
            own = rows.column("own_chunk").to_numpy()
            lo, hi = rows.column("cell_lo").to_numpy(), rows.column("cell_hi").to_numpy()
            table = rows.column("tab").to_numpy()
            vectors = rows.column("x").combine_chunks()
            dims = rows.column("bucket").to_numpy() >> 32
            out: list[list] = [[], [], []]
            for g in np.flatnonzero(np.diff(starts) > 1).tolist():
                a, z = int(starts[g]), int(starts[g + 1])
                unit = _unit(np.array([np.frombuffer(v, np.float32 if len(v) == 4 * dims[a] else np.float64)
                                       for v in vectors[a:z].to_pylist()], dtype=np.float64))
                size = int(dims[a])
                if size not in planes:
                    planes[size] = _planes(size, bits, tables)
                links, edges = _cell_links(unit, lambda u, size=size: _marks(u, planes[size], bits), int(table[a]), weight[a:z],
                                           own[a:z] if lo[a] != hi[a] else None, threshold)
                got = np.flatnonzero(links)
                out[0] += node[a + got].tolist() + [int(node[a + x]) for x, _ in edges]
                out[1] += [None] * len(got) + [int(node[a + y]) for _, y in edges]
                out[2] += links[got].tolist() + [None] * len(edges)
            if out[0]:
                yield common.out_batch(schema, *out)

    return cells.mapInArrow(run, "node long, other long, links long")


def near_duplicates(vectors: DataFrame, column: str = "embedding", threshold: float = THRESHOLD,
                    recall: float = RECALL, group_limit: int = common.GROUP_LIMIT) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id`` and the vector): ``vec_id``, ``n_links`` (other vectors linked
    directly), ``component_id`` (smallest ``vec_id`` reachable by links, itself included), ``kept``
    (``vec_id = component_id``).

    Linked: cosine of ``threshold`` or more in double precision, for pairs that meet in a table
    (equal vectors always do). Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, as do vectors of other lengths among each other.
    Repeated rows link like other equal vectors. A null ``vec_id`` never names a component. An empty
    table gives no row.
    """
    common.ship_package(vectors.sparkSession)
    x = F.col(column).cast("array<double>")
    sound = (x.isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
             & F.exists(x, lambda v: v != 0))
    # Negative zero is zero: x + 0.0 makes the two one vector.
    rows = vectors.select(F.col("vec_id").cast("long"),
                          F.when(sound, F.transform(x, lambda v: v + F.lit(0.0))).alias("x"))
    # A node is a vector with the count of the rows that share it. Its number is given once, in the written table.
    nodes = common.cut(rows.where("x is not null").groupBy("x").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()))
    bits, tables = plan(nodes.count(), threshold, recall)
    signed = _signatures(nodes.select("x", "node", "n"), bits, tables)
    cells = common.split_hot_groups(signed, ["tab", "bucket"], F.col("node"), group_limit)
    found = common.cut(_links(
        cells.repartition("tab", "bucket", "cell_lo", "cell_hi")
        .sortWithinPartitions("tab", "bucket", "cell_lo", "cell_hi"), threshold, bits, tables))
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    linked = common.components(found.where("other is not null"), "node", "other").withColumnRenamed("node", "_n")
    named = common.cut(nodes.join(linked, F.col("node") == F.col("_n"), "left").select(
        "x", "node", "n", "first_id", F.coalesce("component", "node").alias("component"))
        .join(counts, "node", "left").select(
            "x", "first_id", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    ids = common.cut(named.groupBy("component").agg(F.min("first_id").alias("component_id")))
    classes = common.cut(named.join(ids, "component").select("x", "n_links", "component_id"))
    linked_rows = rows.where("x is not null").join(classes, "x").select("vec_id", "n_links", "component_id")
    lone = rows.where("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(lone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
