"""Near-duplicate documents by SimHash, found through anchor points.

A fingerprint has one bit for each of 64 positions: 1 if over half of the text's
word shingles have that bit set in their 64-bit hash.

Candidate search covers the space with anchors. The 64 bits are cut into three
blocks of 22, 21 and 21 bits, each read as a point of the 23-bit space (high bits
zero) whose anchors are the words of the perfect binary Golay code: every point
lies within covering radius 3 of exactly one of its 4096 words, and the anchors of
two blocks together cover their bits with radius 6.

Fingerprints that differ in at most 4 bits differ in at most 2 bits on some pair
of the three blocks (the three pairs' differences sum to at most 8). On that pair
they have a midpoint at distance at most 1 from each. The midpoint's anchor lies
within the covering radius of the midpoint, hence within covering radius plus the
half threshold, 1, of both. So every fingerprint is replicated, for each block
pair, to all anchors within radius plus 1 -- 29 copies on average -- and two
fingerprints that should link meet at an anchor. Sharing the threshold between
the two sides replaces the usual "one at its home anchor, the other at all anchors within
radius plus threshold" (184 copies here) and misses nothing.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_HASHES_AT_ONCE = 1 << 16

#: Fixed value: the generator polynomial of the binary Golay code of length 23,
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
_CHECK_BITS = 11
_BLOCKS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
_PAIRS = ((0, 1), (0, 2), (1, 2))


def text_fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text; 0 if it has no word."""
    words = text.translate(_LOWER).split()  # bytes split at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle_words:
        last = ends[shingle_words - 1:]
        first = first[: len(last)]
    else:
        first, last = first[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), _HASHES_AT_ONCE):
        spans = zip(first[at: at + _HASHES_AT_ONCE].tolist(), last[at: at + _HASHES_AT_ONCE].tolist())
        hashes = np.array([digest(joined[i:j], HASH_SEED) for i, j in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(first)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` for every row, and its long columns ``keep``; ``fp`` holds the 64 bits as a signed long."""
    common.ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), *[(k, pa.int64()) for k in keep]])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [text_fingerprint(t or b"", shingle_words)
                         for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield common.out_batch(schema, part.column("doc_id"),
                                       pa.array(np.array(found, dtype=np.uint64).view(np.int64)),
                                       *[part.column(k) for k in keep])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep).mapInArrow(
        run, ", ".join(["doc_id long, fp long", *[f"{k} long" for k in keep]]))


@lru_cache(maxsize=1)
def _golay_tables():
    """(remainders of the low 12 bits, of the high 11 bits; by syndrome: the error
    of weight 3 or less, the patterns of weight 4 padded with -1)."""
    power = [1]
    for _ in range(22):
        x = power[-1] << 1
        power.append(x ^ GOLAY if x >> _CHECK_BITS else x)

    def remainders(bits):
        table = np.zeros(1 << len(bits), dtype=np.int32)
        for k, p in enumerate(bits):
            half = 1 << k
            table[half: 2 * half] = table[:half] ^ p
        return table

    nearest = np.zeros(1 << _CHECK_BITS, dtype=np.int32)
    next_best: list[list[int]] = [[] for _ in range(1 << _CHECK_BITS)]
    for weight in range(1, 5):
        for places in combinations(range(23), weight):
            syndrome, pattern = 0, 0
            for p in places:
                syndrome ^= power[p]
                pattern |= 1 << p
            if weight < 4:
                nearest[syndrome] = pattern
            else:
                next_best[syndrome].append(pattern)
    width = max(map(len, next_best))
    fourth = np.full((1 << _CHECK_BITS, width), -1, dtype=np.int32)
    for s, patterns in enumerate(next_best):
        fourth[s, : len(patterns)] = patterns
    return remainders(power[:12]), remainders(power[12:]), nearest, fourth


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (row, anchor) with the anchor within covering radius plus 1 of the row's
    fingerprint (uint64) on some block pair. No (row, anchor) comes twice."""
    low, high, nearest, fourth = _golay_tables()
    home, near = [], []
    for start, bits in _BLOCKS:
        v = ((fps >> np.uint64(start)) & np.uint64((1 << bits) - 1)).astype(np.int32)
        syndrome = low[v & 0xFFF] ^ high[v >> 12]
        home.append(((v ^ nearest[syndrome]) >> _CHECK_BITS).astype(np.int64))
        patterns = fourth[syndrome]
        row, col = np.nonzero(patterns >= 0)
        near.append((row, ((v[row] ^ patterns[row, col]) >> _CHECK_BITS).astype(np.int64)))
    rows, keys = [], []
    every = np.arange(len(fps))
    for k, (i, j) in enumerate(_PAIRS):
        tag = np.int64(k) << np.int64(24)
        rows += [every, near[i][0], near[j][0]]
        keys += [tag | home[i] << 12 | home[j], tag | near[i][1] << 12 | home[j][near[i][0]],
                 tag | home[i][near[j][0]] << 12 | near[j][1]]
    return np.concatenate(rows), np.concatenate(keys)


def _replicas(distinct: DataFrame) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("fp", pa.int64()), ("rep", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                fp, rep = part.column("fp").to_numpy(), part.column("rep").to_numpy()
                row, key = anchors(fp.view(np.uint64))
                yield common.out_batch(schema, pa.array(key), pa.array(fp[row]), pa.array(rep[row]))

    return distinct.mapInArrow(run, "anchor long, fp long, rep long")


_SMALL = 8


def _links_of_group(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the group's links: each step takes a reached member
    and compares it with those not reached yet, so a dense group costs about one pass."""
    links, left = [], np.arange(len(fp))
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            at = reached.pop()
            hit = np.bitwise_count(fp[left] ^ fp[at]) <= max_bits
            if hit.any():
                new = left[hit].tolist()
                links += [(at, x) for x in new]
                reached += new
                left = left[~hit]
    return links


def _links(cells: DataFrame, max_bits: int) -> DataFrame:
    """Compare per anchor; edges ``(a, b)`` between representatives that link,
    enough of them to connect what each cell connects."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for rows, starts in common.sorted_runs(batches, ["anchor", "cell_lo", "cell_hi"]):
            fp = rows.column("fp").to_numpy().view(np.uint64)
            rep = rows.column("rep").to_numpy()
            if starts[-1] != len(fp):
                starts = np.append(starts, len(fp))
            sizes = np.diff(starts)
            group = np.repeat(np.arange(len(sizes)), sizes)
            few = np.flatnonzero((sizes > 1) & (sizes <= _SMALL))
            pick = np.flatnonzero(np.isin(group, few, assume_unique=False)) if len(few) else few
            left, right = [], []
            for step in range(1, _SMALL):  # all pairs of the small groups, step by step
                if len(pick) <= step:
                    break
                i, j = pick[:-step], pick[step:]
                hit = (group[i] == group[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= max_bits)
                left.append(rep[i[hit]])
                right.append(rep[j[hit]])
            for g in np.flatnonzero(sizes > _SMALL).tolist():
                at = starts[g]
                pairs = np.array(_links_of_group(fp[at: starts[g + 1]], max_bits), dtype=np.int64).reshape(-1, 2)
                left.append(rep[at + pairs[:, 0]])
                right.append(rep[at + pairs[:, 1]])
            if left:
                yield common.out_batch(schema, pa.array(np.concatenate(left)), pa.array(np.concatenate(right)))

    return cells.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    group_limit: int = common.GROUP_LIMIT) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``fingerprint`` (16
    lowercase hex digits), ``component_id`` (smallest ``doc_id`` reachable by links of at
    most ``max_bits`` differing bits, itself included).

    Null and empty texts have fingerprint zero and link like any other. Repeated
    rows each keep their row. A null ``doc_id`` never names a component: its row takes
    the smallest id of its component, null if that has none. An empty table gives no row.
    """
    fps = common.cut(fingerprints(docs, shingle_words))
    named = _components(fps, max_bits, group_limit)
    ids = common.cut(named.groupBy("component").agg(F.min("first_id").alias("component_id")))
    classes = common.cut(named.join(ids, "component").select("fp", "component_id"))
    return fps.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _components(fps: DataFrame, max_bits: int, group_limit: int) -> DataFrame:
    """``(fp, first_id, component)``: every fingerprint, its smallest id, and the smallest fingerprint it reaches."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be within 0 to 4: the blocks and radii are chosen for 4 bits")
    # Equal fingerprints are one node, named by its smallest id; ids can be
    # null, so nodes are the fingerprints' own 64 bits until the end.
    distinct = common.cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    replicas = _replicas(distinct.select("fp", F.col("fp").alias("rep")))
    cells = common.split_hot_groups(replicas, ["anchor"], F.col("fp"), group_limit)
    cells = (cells.select("anchor", "cell_lo", "cell_hi", "fp", "rep")
             .repartition("anchor", "cell_lo", "cell_hi")
             .sortWithinPartitions("anchor", "cell_lo", "cell_hi"))
    linked = common.components(_links(cells, max_bits), "a", "b")
    return common.cut(distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")))


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               group_limit: int = common.GROUP_LIMIT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, null last; of several with that
    id the one whose text, and then whose row, hashes lowest. Rows stand for themselves: two texts under one id are
    compared like any others, and rows without an id too. Of rows that are equal throughout one stays.
    """
    names, keys = docs.columns, ("_text_1", "_text_2", "_row")
    text = F.col("text").cast("string")
    marked = docs.withColumns({"_text_1": F.xxhash64(text), "_text_2": F.xxhash64(text, F.lit(1)), "_row": F.xxhash64(*names)})
    fps = common.cut(fingerprints(marked, shingle_words, keys))
    classes = _components(fps, max_bits, group_limit).select("fp", "component")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *keys)
    first = common.cut(fps.join(classes, "fp").groupBy("component").agg(F.min(rank).alias("first"))
                       .select(*[F.col(f"first.{k}") for k in keys]))
    # The three hashes, 192 bits, stand for the row. Equal rows become one before the shuffle, which both steps share.
    return marked.dropDuplicates(list(keys)).join(first, list(keys), "left_semi").select(*names)
