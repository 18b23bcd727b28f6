"""Exact top-k inner products through a bit-sliced index.

Vectors are quantised to integers. A block of candidate rows is stored as bitmaps, one
for each bit of each component (offset so that all are positive), a bit a row. For a
query the score of all rows of a block is built as bitmaps too: every set bit of a
query component adds that component's slices, shifted, with carry-save bitmap
arithmetic; a negative component adds the complemented slices, which differs by a constant.
The k best rows come from the most significant slice downward: rows that have the
bit while the threshold's prefix is equal are above it. Rows that are still equal after
the last slice have the same score, and the smallest ids among them fill up the k.

Blocks of candidates meet blocks of queries as pairs spread over the cluster; a pair
emits at most k rows a query, and a window limited to k rows on both sides of its shuffle
joins them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm import common

SCALE = 256
QUERY_EVERY = 50
K = 5
#: Candidates of a block, which are a few MB, and queries that meet it at once: the index travels once for so many.
BLOCK_ROWS = 32768
BLOCK_QUERIES = 4096


@dataclass
class SlicedBlock:
    """Bit slices of a block's components; rows are in ascending id."""

    ids: np.ndarray  # int64, ascending
    times: np.ndarray  # int64: how often the row occurs
    low: np.ndarray  # int64 a component: the offset taken off its values
    width: int  # bits a component
    slices: np.ndarray  # uint64 (components, width, words)

    @classmethod
    def build(cls, ids: np.ndarray, times: np.ndarray, values: np.ndarray) -> "SlicedBlock":
        order = np.argsort(ids, kind="stable")
        ids, times, values = ids[order], times[order], values[order]
        low = values.min(axis=0)
        raised = (values - low).astype(np.uint64)
        width = max(int(raised.max(initial=0)).bit_length(), 1)
        n, dims = values.shape
        words = -(-n // 64)
        slices = np.zeros((dims, width, words), dtype=np.uint64)
        for b in range(width):
            bits = np.zeros((dims, words * 64), dtype=np.uint8)
            bits[:, :n] = ((raised >> np.uint64(b)) & np.uint64(1)).T
            slices[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
        return cls(ids, times, low, width, slices)

    def to_bytes(self) -> tuple[bytes, bytes, bytes, int, bytes]:
        return self.ids.tobytes(), self.times.tobytes(), self.low.tobytes(), self.width, self.slices.tobytes()

    @classmethod
    def from_bytes(cls, ids: bytes, times: bytes, low: bytes, width: int, slices: bytes) -> "SlicedBlock":
        ids, times, low = (np.frombuffer(x, np.int64) for x in (ids, times, low))
        return cls(ids, times, low, width, np.frombuffer(slices, np.uint64).reshape(len(low), width, -1))

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """(slices of score minus constant, least significant first; the constant)."""
        ones = ~np.uint64(0)
        top = (1 << self.width) - 1
        constant = int(sum(int(q) * int(v) for q, v in zip(query, self.low)))
        columns: list[list[np.ndarray]] = []  # bitmaps waiting to be added, by weight
        for j in np.flatnonzero(query).tolist():
            q = int(query[j])
            component = self.slices[j]
            if q < 0:  # q * v = |q| * (top - v) - |q| * top
                component, q = component ^ ones, -q
                constant -= q * top
            shift = 0
            while q:
                if q & 1:
                    while len(columns) < shift + self.width:
                        columns.append([])
                    for b in range(self.width):
                        columns[shift + b].append(component[b])
                q >>= 1
                shift += 1
        out = []
        at = 0
        while at < len(columns):
            pending = columns[at]
            if len(pending) > 1 and at + 1 == len(columns):
                columns.append([])
            while len(pending) > 1:
                # Full adders on many bitmaps at once: three of a weight make one of it and one of the next.
                if len(pending) >= 3:
                    third = len(pending) // 3
                    stack = np.stack(pending[: 3 * third])
                    a, b, c = stack[:third], stack[third: 2 * third], stack[2 * third:]
                    half = a ^ b
                    carry = (a & b) | (half & c)
                    pending = list(half ^ c) + pending[3 * third:]
                    columns[at + 1] += list(carry)
                else:
                    a, b = pending
                    pending = [a ^ b]
                    columns[at + 1].append(a & b)
            out.append(pending[0] if pending else np.zeros(self.slices.shape[2], dtype=np.uint64))
            at += 1
        return out, constant

    def top(self, query: np.ndarray, query_id: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best rows with another id than ``query_id``, ties to smaller ids."""
        n = len(self.ids)
        alive = np.zeros(self.slices.shape[2] * 64, dtype=np.uint8)
        alive[:n] = 1
        if query_id is not None:
            a, z = np.searchsorted(self.ids, [query_id, query_id + 1])
            alive[a:z] = 0
        k = min(k, int(alive.sum()))
        if not k:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        scores, constant = self.score_slices(query)
        above = np.zeros(self.slices.shape[2], dtype=np.uint64)
        equal = np.packbits(alive, bitorder="little").view("<u8").astype(np.uint64)
        for s in reversed(scores):
            maybe = above | (equal & s)
            count = int(np.bitwise_count(maybe).sum())
            if count > k:
                equal = equal & s
            else:
                above = maybe
                equal = equal & ~s
                if count == k:
                    break
        rows = _set_bits(above)
        if len(rows) < k:  # equal scores: the rows are in order of their ids
            rows = np.concatenate([rows, _set_bits(equal)[: k - len(rows)]])
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        found = np.full(len(rows), constant, dtype=np.int64)
        for b, s in enumerate(scores):
            found += ((s[word] >> bit) & np.uint64(1)).astype(np.int64) << b
        return rows, found


def _set_bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.ascontiguousarray(bitmap).view(np.uint8), bitorder="little"))


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, q array<long>)``: floor(SCALE * x) of each component; rows whose vector is null,
    or holds a null or non-finite component, are left out."""
    x = F.col(column).cast("array<double>")
    sound = x.isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(sound & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), F.transform(x, lambda v: F.floor(v * SCALE)).alias("q"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows; components a shorter vector lacks are zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of quantised ``vectors``: one row a block of about ``block_rows`` rows,
    dealt by a hash of the row, so equal ids and hot values spread. Equal rows are counted."""
    vectors = vectors.groupBy("vec_id", "q").agg(F.count(F.lit(1)).alias("times"))
    n = vectors.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    blocks, dims = max(-(-n[0] // block_rows), 1), max(n[1] or 0, 1)
    schema = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("times", pa.binary()), ("low", pa.binary()), ("width", pa.int32()),
                        ("slices", pa.binary())])

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        made = SlicedBlock.build(rows.column("vec_id").to_numpy(), rows.column("times").to_numpy(),
                                  _matrix(rows.column("q").chunk(0), dims))
        return pa.Table.from_batches([common.out_batch(
            schema, [rows.column("block")[0].as_py()], *[[x] for x in made.to_bytes()])])

    dealt = vectors.withColumn("block", common.hash_bucket(blocks, F.col("vec_id"), F.col("q")))
    return common.cut(dealt.groupBy("block").applyInArrow(
        build, "block long, ids binary, times binary, low binary, width int, slices binary"))


def _query_blocks(queries: DataFrame, size: int) -> DataFrame:
    """One row a block of queries: ids, and the vectors as int64 bytes."""
    n = queries.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    blocks, dims = max(-(-n[0] // size), 1), max(n[1] or 0, 1)
    schema = pa.schema([("q_block", pa.int64()), ("q_ids", pa.binary()), ("q_dims", pa.int32()), ("q_values", pa.binary())])

    def gather(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        values = _matrix(rows.column("q").chunk(0), dims)
        return pa.Table.from_batches([common.out_batch(
            schema, [rows.column("q_block")[0].as_py()], [rows.column("vec_id").to_numpy().tobytes()],
            [dims], [values.tobytes()])])

    return common.cut(queries.withColumn("q_block", common.hash_bucket(blocks, F.col("vec_id"), F.col("q")))
                      .groupBy("q_block").applyInArrow(
                          gather, "q_block long, q_ids binary, q_dims int, q_values binary"))


def top_k(queries: DataFrame, indexed: DataFrame, k: int = K, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of quantised ``queries`` its ``k`` highest integer
    inner products over all rows of the index with another id (all, if fewer), ties to smaller ids.

    Rows with equal id and vector ask once; rows with equal id and other vectors are queries
    of their own (``query_hash`` tells them apart). Components that one side lacks count zero.
    """
    asked = _query_blocks(queries.dropDuplicates(["vec_id", "q"]), block_queries)
    left = indexed.agg(F.max("block")).first()[0]
    right = asked.agg(F.max("q_block")).first()[0]
    schema = pa.schema([("query_id", pa.int64()), ("query_hash", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64()), ("times", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = SlicedBlock.from_bytes(row["ids"], row["times"], row["low"], row["width"], row["slices"])
                asked_ids = np.frombuffer(row["q_ids"], np.int64).tolist()
                values = np.frombuffer(row["q_values"], np.int64).reshape(-1, row["q_dims"])
                lacks = max(len(block.low) - values.shape[1], 0)
                fitted = np.pad(values, ((0, 0), (0, lacks)))[:, : len(block.low)]
                got: list[list] = [[], [], [], [], []]
                for query_id, whole, query in zip(asked_ids, values, fitted):
                    rows, scores = block.top(query, query_id, k)
                    # Padding does not change a query, so it does not change its mark.
                    mark = hashlib.blake2b(np.trim_zeros(whole, "b").tobytes(), digest_size=8).digest()
                    got[0] += [query_id] * len(rows)
                    got[1] += [int.from_bytes(mark, "little", signed=True)] * len(rows)
                    got[2] += block.ids[rows].tolist()
                    got[3] += scores.tolist()
                    got[4] += np.minimum(block.times[rows], k).tolist()
                yield common.out_batch(schema, *got)

    # Every pair of blocks once, spread by its own key: not a join of rows, and no block is broadcast.
    pair = ["block", "q_block"]
    spread = (indexed.withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(right or 0).cast("long"))))
              .hint("shuffle_merge")
              .join(asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(left or 0).cast("long")))),
                    pair))
    found = (spread.mapInArrow(run, "query_id long, query_hash long, vec_id long, score long, times long")
             .withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))))
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "query_hash"))


def search(vectors: DataFrame, query_every: int = QUERY_EVERY, k: int = K, column: str = "embedding",
           block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Exact top ``k`` for the rows whose ``vec_id`` is divisible by ``query_every``, against all rows.

    Null ids, null vectors and vectors with a null or non-finite component take no part.
    Empty vectors score 0. Repeated rows are candidates each, but never of a query with their
    own id. Scores and sums must fit 63 bits. An empty table gives no row.
    """
    common.ship_package(vectors.sparkSession)
    sound = quantised(vectors, column)
    return top_k(sound.where(F.col("vec_id") % query_every == 0), index(sound, block_rows), k, block_queries)
