"""Product codes of vectors, their codebooks fitted by dual-tree Lloyd rounds over all rows.

Vectors become integers and are cut into parts; each part position has a codebook. A round assigns every part to its
nearest entry and moves entries to the floor of their parts' mean. Both sides are trees: the parts of a
block of rows, halved along their widest side down to small leaves, and the codebook's entries, down to single ones.
Pairs of nodes go down both trees together. A pair whose boxes are further apart than the parts' box is
from some other entries' box at most is dropped; parts whose node is left with one entry are assigned
at once, their count and sum taken from the node. Leaves that stay between several entries are compared one by one.
All distances are integers, so bounds and ties are exact.

A task handles one block of rows at a time and sends one sum an entry and component; the codebooks,
which are of fixed size, are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Rows whose trees a task builds at once, and parts of a leaf.
BLOCK_ROWS, LEAF = 16384, 32
#: Distances that are computed at once for uncertain leaves.
_AT_ONCE = 1 << 18


class Tree:
    """Balanced trees over points, one for each part position; level 0 is the roots."""

    def __init__(self, points: np.ndarray, leaf: int, weighted: bool = False):
        """``points``: int64 (positions, n, components). Each tree is filled up with copies of its last point."""
        positions, n, width = points.shape
        self.levels = max(int(np.ceil(np.log2(max(n / leaf, 1)))), 0)
        size = 2**self.levels * -(-n // 2**self.levels)
        order = np.broadcast_to(np.minimum(np.arange(size), n - 1), (positions, size))
        real = np.broadcast_to(np.arange(size) < n, (positions, size))
        self.points = np.take_along_axis(points, order[:, :, None], axis=1)
        self.index = np.where(real, order, -1)
        for level in range(self.levels):
            nodes = self.points.reshape(positions * 2**level, -1, width)
            widest = (nodes.max(axis=1) - nodes.min(axis=1)).argmax(axis=1)
            along = np.take_along_axis(nodes, widest[:, None, None], axis=2)[:, :, 0]
            halved = np.argpartition(along, along.shape[1] // 2, axis=1)
            self.points = np.take_along_axis(nodes, halved[:, :, None], axis=1).reshape(positions, size, width)
            self.index = np.take_along_axis(self.index.reshape(len(nodes), -1), halved, axis=1).reshape(positions, size)
        leaves = self.points.reshape(positions, 2**self.levels, -1, width)
        self.low, self.high = [leaves.min(axis=2)], [leaves.max(axis=2)]
        own = (self.index >= 0).reshape(positions, 2**self.levels, -1)
        self.count = [own.sum(axis=2)] if weighted else []
        self.total = [(leaves * own[..., None]).sum(axis=2)] if weighted else []
        for _ in range(self.levels):
            pair = lambda x: x[0].reshape(positions, -1, 2, *x[0].shape[2:])
            self.low.insert(0, pair(self.low).min(axis=2))
            self.high.insert(0, pair(self.high).max(axis=2))
            if weighted:
                self.count.insert(0, pair(self.count).sum(axis=2))
                self.total.insert(0, pair(self.total).sum(axis=2))


def _distances(a: Tree, b: Tree, level: int, b_level: int, at: np.ndarray, x: np.ndarray, y: np.ndarray):
    """(least, greatest) squared distance between the boxes of node pairs."""
    a_low, a_high, b_low, b_high = a.low[level][at, x], a.high[level][at, x], b.low[b_level][at, y], b.high[b_level][at, y]
    apart = np.maximum(np.maximum(b_low - a_high, a_low - b_high), 0)
    across = np.maximum(b_high - a_low, a_high - b_low)
    return (apart * apart).sum(axis=1), (across * across).sum(axis=1)


def _runs(of: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, np.int64)


class Assignment:
    """Nearest entries of the parts of one block, by both trees."""

    def __init__(self, parts: np.ndarray, books: np.ndarray):
        """``parts``: int64 (positions, rows, components), ``books``: (positions, entries, components)."""
        positions, entries = books.shape[:2]
        self.parts, self.books = Tree(parts, LEAF, weighted=True), Tree(books, 1)
        same = (books[:, :, None] == books[:, None]).all(axis=3)  # an entry like an earlier one is never nearest
        self.first = same.argmax(axis=2) == np.arange(entries)
        #: Whole nodes: (level, position, node, entry); uncertain leaves: (position, leaf, entry) pairs.
        self.whole: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        at, x, y = np.arange(positions), np.zeros(positions, dtype=np.int64), np.zeros(positions, dtype=np.int64)
        level = b_level = 0
        while True:
            least, most = _distances(self.parts, self.books, level, b_level, at, x, y)
            node = at * 2**level + x
            starts = _runs(node)
            within = np.repeat(np.minimum.reduceat(most, starts), np.diff(np.append(starts, len(node))))
            keep = least <= within
            at, x, y = at[keep], x[keep], y[keep]
            if b_level == self.books.levels:
                entry = self.books.index[at, y]
                keep = (entry >= 0) & self.first[at, entry]
                at, x, y = at[keep], x[keep], y[keep]
                node = at * 2**level + x
                starts = _runs(node)
                alone = np.diff(np.append(starts, len(node))) == 1
                only = starts[alone]
                self.whole.append((level, at[only], x[only], self.books.index[at[only], y[only]]))
                keep = np.ones(len(node), dtype=bool)
                keep[only] = False
                at, x, y = at[keep], x[keep], y[keep]
                if level == self.parts.levels or not len(at):
                    break
            if b_level < self.books.levels:
                at, x, y = np.repeat(at, 2), np.repeat(x, 2), np.repeat(2 * y, 2) + np.tile([0, 1], len(y))
                b_level += 1
            if level < self.parts.levels:
                at, x, y = np.repeat(at, 2), np.repeat(2 * x, 2) + np.tile([0, 1], len(x)), np.repeat(y, 2)
                level += 1
                by_node = np.argsort(at * 2**level + x, kind="stable")
                at, x, y = at[by_node], x[by_node], y[by_node]
        self.pairs = at, x, self.books.index[at, y]

    def uncertain(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(positions, places in the tree, entries) of the parts of uncertain leaves, one by one."""
        at, leaf, entry = self.pairs
        if not len(at):
            return
        size = self.parts.points.shape[1] >> self.parts.levels
        starts = np.append(_runs(at * 2**self.parts.levels + leaf), len(at))
        books = self.books_by_index()
        entries = books.shape[1]
        a = 0
        while a < len(starts) - 1:
            z = max(int(np.searchsorted(starts, starts[a] + _AT_ONCE // size, "right")) - 1, a + 1)
            rows = slice(starts[a], starts[z])
            place = leaf[rows, None] * size + np.arange(size)
            apart = self.parts.points[at[rows, None], place] - books[at[rows], entry[rows]][:, None]
            # Distance and entry in one number: ties go to the lower entry.
            both = (apart * apart).sum(axis=2) * entries + entry[rows, None]
            head = starts[a:z] - starts[a]
            yield (np.repeat(at[starts[a:z]], size), place[head].reshape(-1),
                   (np.minimum.reduceat(both, head, axis=0) % entries).reshape(-1))
            a = z

    def books_by_index(self) -> np.ndarray:
        positions, entries = self.first.shape
        out = np.zeros((positions, entries, self.books.points.shape[2]), dtype=np.int64)
        at, y = np.nonzero(self.books.index >= 0)
        out[at, self.books.index[at, y]] = self.books.points[at, y]
        return out

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """(parts, their componentwise sums) of every position's entries."""
        positions, entries = self.first.shape
        count = np.zeros((positions, entries), dtype=np.int64)
        total = np.zeros((positions, entries, self.parts.points.shape[2]), dtype=np.int64)
        for level, at, x, entry in self.whole:
            np.add.at(count, (at, entry), self.parts.count[level][at, x])
            np.add.at(total, (at, entry), self.parts.total[level][at, x])
        for at, place, entry in self.uncertain():
            own = self.parts.index[at, place] >= 0
            np.add.at(count, (at[own], entry[own]), 1)
            np.add.at(total, (at[own], entry[own]), self.parts.points[at[own], place[own]])
        return count, total

    def nearest(self, rows: int) -> np.ndarray:
        """int64 (positions, rows): each part's entry."""
        found = np.zeros(self.parts.index.shape, dtype=np.int64)
        for level, at, x, entry in self.whole:
            size = found.shape[1] >> level
            found.reshape(len(found), -1, size)[at, x] = entry[:, None]
        for at, place, entry in self.uncertain():
            found[at, place] = entry
        out = np.zeros((len(found), rows), dtype=np.int64)
        at, place = np.nonzero(self.parts.index >= 0)
        out[at, self.parts.index[at, place]] = found[at, place]
        return out


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, label, q array<long>)``: floor(SCALE * x) of each component, without rows whose vector is null
    or holds a null or non-finite component."""
    x = F.col(column).cast("array<double>")
    sound = x.isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                                       F.transform(x, lambda v: F.floor(v * SCALE)).alias("q"))


def _parts(column: pa.Array, positions: int, width: int) -> np.ndarray:
    """int64 (positions, rows, width); components that a vector lacks are zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), positions * width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return np.ascontiguousarray(out.reshape(len(lengths), positions, width).transpose(1, 0, 2))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(BLOCK_ROWS)
            held = []
    if held:
        yield from (b for b in pa.Table.from_batches(held).combine_chunks().to_batches(BLOCK_ROWS) if b.num_rows)


def lloyd_round(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round over quantised ``rows``: (positions, entries, components)."""
    positions, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)  # of fixed size
    schema = pa.schema([("cell", pa.int64()), ("total", pa.int64()), ("n", pa.int64())])

    def run(batches):
        count = np.zeros((positions, entries), dtype=np.int64)
        total = np.zeros((positions, entries, width), dtype=np.int64)
        for block in _blocks(batches):
            n, t = Assignment(_parts(block.column("q"), positions, width), shared.value).sums()
            count += n
            total += t
        used = np.flatnonzero(np.repeat(count.reshape(-1), width))
        yield common.out_batch(schema, used, total.reshape(-1)[used], np.repeat(count.reshape(-1), width)[used])

    moved = books.reshape(-1).copy()
    for r in (rows.select("q").mapInArrow(run, "cell long, total long, n long").groupBy("cell")
              .agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()):  # one row a component of the books
        moved[r.cell] = r.total // r.n
    return moved.reshape(books.shape)


def first_books(rows: DataFrame, positions: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the rows with the smallest ids (null last, equal ids in order of their components)."""
    longest = rows.agg(F.max(F.size("q"))).first()[0] or 0
    width = max(-(-longest // positions), 1)
    few = [r.q for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()]
    return _parts(pa.array(few, pa.list_(pa.int64())), positions, width)


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(vec_id, label, code, error)`` of quantised ``rows``."""
    positions, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)
    label = rows.schema["label"].dataType.simpleString()

    def run(batches):
        for block in _blocks(batches):
            parts = _parts(block.column("q"), positions, width)
            entry = Assignment(parts, shared.value).nearest(block.num_rows)
            apart = parts - np.take_along_axis(shared.value, entry[:, :, None], axis=1)
            error = (apart * apart).sum(axis=(0, 2))
            codes = entry.T.astype(np.uint8).tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("label"),
                 pa.array([codes[a: a + 2 * positions] for a in range(0, len(codes), 2 * positions)], pa.string()),
                 pa.array(error)], names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compress(vectors: DataFrame, column: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """One row per sound row of ``vectors`` (``vec_id``, ``label``, a vector): ``vec_id``, ``code`` (two hex digits a
    part), ``error``, ``label_error`` (errors summed over equal labels, nulls together), ``codebooks_sha256``.

    Vectors that are null or hold null or non-finite components are left out. Parts are a sixteenth of the longest vector;
    components that a vector lacks are zero. Repeated rows each count; a null id sorts last, a missing ``label``
    column is all null. With fewer rows than entries there are as many entries as rows. Squared
    distances must fit 57 bits and sums 63. An empty table gives no row.
    """
    common.ship_package(vectors.sparkSession)
    rows = common.cut(quantised(vectors, column))
    books = first_books(rows)
    for _ in range(rounds if books.shape[1] else 0):
        books = lloyd_round(rows, books)
    mark = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = common.cut(encode(rows, books))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(mark).alias("codebooks_sha256")))


def _oracle() -> str:
    def assigned(k: int) -> str:
        return f"""
    a{k} AS (SELECT rid, p.part, any_value(p.x) AS x, CAST(min(list_sum(list_transform(list_zip(p.x, b.x),
                 lambda t: (t[1] - t[2]) * (t[1] - t[2]))) * 64 + entry) AS BIGINT) AS best
             FROM p JOIN b{k} b ON b.part = p.part GROUP BY rid, p.part)"""

    def moved(k: int) -> str:
        return f"""
    b{k + 1} AS (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
                 SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
                     SELECT part, best % 64 AS entry, i, sum(x[i]) AS s, count(*) AS n
                     FROM a{k}, (SELECT unnest(range(1, (SELECT w + 1 FROM width))) AS i) GROUP BY ALL)
                 GROUP BY part, entry) m USING (part, entry))"""

    return f"""
    WITH v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS rid, vec_id, label,
                      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
               FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    width AS (SELECT CAST(greatest(ceil(max(len(q)) / 16), 1) AS BIGINT) AS w FROM v),
    p AS (SELECT rid, part, q[part * w + 1 : part * w + w] AS x
          FROM v, width, (SELECT unnest(range({PARTS})) AS part)),
    b0 AS (SELECT part, rid AS entry, x FROM p WHERE rid < {ENTRIES}),{assigned(0)},{moved(0)},{assigned(1)},{moved(1)},{assigned(2)},
    mark AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS m FROM b2),
    coded AS (SELECT rid, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code,
                     CAST(sum(best // 64) AS BIGINT) AS error FROM a2 GROUP BY rid)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           m AS codebooks_sha256
    FROM v JOIN coded USING (rid), mark
    """


#: The same in plain SQL: every part against every entry.
ORACLE_SQL = _oracle()
