"""Ranked lexical search: the best documents for each item, exactly, without scoring them all.

A document is a vector of impacts over the items' terms, its length the norm of what its impacts
could bring. Vectors are ordered by length, longest first, and cut into buckets of similar length. An item needs no
bucket whose longest vector, by the Cauchy-Schwarz inequality, cannot reach the item's threshold. Inside a
bucket the item's rarest terms are looked up first: what they bring, plus the product of the lengths of what
is left of item and document, bounds each document's score, and only documents whose bound reaches the
threshold are scored, in integers.

Documents stay in the tasks that read them. A first pass over the tasks' longest vectors gives each item a
threshold that holds everywhere, a second pass searches all buckets from there; what is shuffled is at
most ``k`` rows an item and task. Items travel in blocks of bounded size, so their table may grow too.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm import common
from pulse.session import shared_dir

#: What stands between terms: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
#: Terms of the items that are searched for at once (an item with more is a block of its own).
BLOCK_TERMS = 1 << 20
#: Vectors of a bucket, and entries of the vectors that a task orders at once.
BUCKET_DOCS, TASK_ENTRIES = 2048, 4 << 20
#: An item's rarest terms, which are looked up before the others.
FOCUS = 4
#: Relative error that bounds in floating point may have; scores are integers.
_ROUNDING = 1e-9

_VECTOR = "doc_id long, tie long, n long, terms array<int>, counts array<int>"
_FOUND = "item int, doc_id long, tie long, score long"


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(terms of all texts, A-Z lower-cased, end to end; text of each term). Null has none."""
    found = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=BETWEEN)
    flat = found.flatten()
    text = np.repeat(np.arange(len(texts)), np.diff(found.offsets.to_numpy()))
    some = pc.not_equal(flat, "")
    return flat.filter(some), text[some.to_numpy(zero_copy_only=False)]


def _item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, tie, terms)``: distinct terms of each distinct row of ``items`` (``item_id``, ``text``)."""
    schema = pa.schema([("item_id", pa.int64()), ("tie", pa.int64()), ("terms", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            for part in common.parts(batch):
                flat, text = split_terms(part.column("text"))
                flat = flat.to_pylist()
                ends = np.searchsorted(text, np.arange(part.num_rows + 1)).tolist()
                yield common.out_batch(schema, part.column("item_id"), part.column("tie"),
                                       [sorted(set(flat[a:z])) for a, z in zip(ends, ends[1:])])

    rows = items.select(F.col("item_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("tie"),
                        F.col("text").cast("string").alias("text")).dropDuplicates(["item_id", "tie"])
    return rows.select("item_id", "tie", "text").mapInArrow(run, "item_id long, tie long, terms array<string>")


@dataclass
class Items:
    """A block of items: their terms by number, and what the corpus says about them."""

    names: list[str]
    terms: list[np.ndarray]  # an item's term numbers
    weights: np.ndarray | None = None  # int64 a term
    n_docs: int = 0
    n_terms: int = 0
    least: np.ndarray | None = None  # int64 an item: the score it must reach

    @classmethod
    def of(cls, rows: list[list[str]]) -> "Items":
        names = sorted({t for terms in rows for t in terms})
        number = {t: k for k, t in enumerate(names)}
        return cls(names, [np.array([number[t] for t in terms], dtype=np.int64) for terms in rows])

    def weigh(self, n_docs: int, n_terms: int, df: np.ndarray) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()],
                                dtype=np.int64)
        self.least = np.ones(len(self.terms), dtype=np.int64)

    def impacts(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Impacts of terms that occur ``counts`` times in documents of ``sizes`` terms."""
        m = 50 + (50 * sizes * self.n_docs) // max(self.n_terms, 1)
        return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def _vectors(docs: DataFrame, names: list[str]) -> DataFrame:
    """Every document with a term: its size and how often it holds each of ``names``."""
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n", pa.int64()),
                        ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
    shared = docs.sparkSession.sparkContext.broadcast(names)  # a block's terms: bounded by BLOCK_TERMS

    def run(batches):
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            for part in common.parts(batch):
                flat, text = split_terms(part.column("text"))
                sizes = np.bincount(text, minlength=part.num_rows)
                at = pc.index_in(flat, value_set=known)
                of_items = at.is_valid().to_numpy(zero_copy_only=False)
                entry, counts = np.unique(text[of_items] * max(len(known), 1) + at.drop_null().to_numpy(), return_counts=True)
                doc, term = np.divmod(entry, max(len(known), 1))
                some = np.flatnonzero(sizes)
                ends = np.searchsorted(doc, np.append(some, part.num_rows)).astype(np.int32)
                kept = part.take(pa.array(some))
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (term, counts)]
                yield common.out_batch(schema, kept.column("doc_id"), kept.column("tie"), sizes[some], *lists)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("tie"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _VECTOR)


def _corpus(vectors: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms with repeats, documents that hold each of the ``n_terms`` numbered terms)."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def run(batches):
        docs = size = 0
        df = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            docs += batch.num_rows
            size += int(batch.column("n").to_numpy().sum())
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(df)
        yield common.out_batch(schema, np.concatenate([[-2, -1], some]).astype(np.int32),
                               np.concatenate([[docs, size], df[some]]).astype(np.int64))

    total = dict.fromkeys((-2, -1), 0)
    total.update((r.term, r.n) for r in vectors.select("n", "terms").mapInArrow(run, "term int, n long")
                 .groupBy("term").agg(F.sum("n").alias("n")).collect())  # one row a term of the block
    df = np.zeros(n_terms, dtype=np.int64)
    for term, n in total.items():
        if term >= 0:
            df[term] = n
    return total[-2], total[-1], df


class Vectors:
    """Impact vectors of some documents, longest first, in buckets."""

    def __init__(self, items: Items, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray,
                 bucket: int):
        self.items, self.bucket = items, bucket
        lengths = np.diff(starts)
        impact = items.impacts(counts, np.repeat(sizes, lengths))
        square = items.weights[terms] * impact.astype(np.float64) ** 2
        length2 = np.add.reduceat(square, starts[:-1]) if len(terms) else np.zeros(0)
        self.order = np.argsort(-length2, kind="stable")
        self.length2 = length2[self.order]
        lengths = lengths[self.order]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(starts[:-1][self.order] - self.starts[:-1], lengths) + np.arange(len(terms))
        self.terms, self.impact, self.square = terms[at], impact[at], square[at]

    def scores(self, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Exact scores of these vectors for an item's ``terms``."""
        if not len(rows):
            return np.empty(0, np.int64)
        weight = np.zeros(len(self.items.names), dtype=np.int64)
        weight[terms] = self.items.weights[terms]
        lengths = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[rows] - (ends - lengths), lengths) + np.arange(ends[-1])
        return np.add.reduceat(weight[self.terms[at]] * self.impact[at], ends - lengths)

    def buckets(self) -> Iterator["Bucket"]:
        for a in range(0, len(self.order), self.bucket):
            yield Bucket(self, a, min(a + self.bucket, len(self.order)))


class Bucket:
    """Vectors of similar length, by term."""

    def __init__(self, vectors: Vectors, first: int, end: int):
        self.vectors, self.items, self.first, self.size = vectors, vectors.items, first, end - first
        self.length2 = vectors.length2[first:end]
        a, z = vectors.starts[first], vectors.starts[end]
        doc = np.repeat(np.arange(self.size), np.diff(vectors.starts[first: end + 1]))
        terms = vectors.terms[a:z]
        by_term = np.argsort(terms, kind="stable")
        self.doc, self.impact, self.square = doc[by_term], vectors.impact[a:z][by_term], vectors.square[a:z][by_term]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(self.items.names)))])

    def reachable(self, length2: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Items of these squared lengths that the longest vector could satisfy."""
        return np.flatnonzero(np.sqrt(length2 * self.length2[0]) * (1 + _ROUNDING) >= least)

    def search(self, terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(vectors whose score for an item's ``terms``, rarest first, reaches ``least``; the scores)."""
        weights = self.items.weights[terms]
        seen, seen2 = np.zeros(self.size, dtype=np.int64), np.zeros(self.size)
        for term, weight in zip(terms[:FOCUS].tolist(), weights.tolist()):
            entries = slice(self.ends[term], self.ends[term + 1])
            at = self.doc[entries]
            seen[at] += weight * self.impact[entries]
            seen2[at] += self.square[entries]
        rest = weights[FOCUS:].sum() * np.maximum(self.length2 * (1 + _ROUNDING) - seen2, 0)
        maybe = np.flatnonzero((seen + np.sqrt(rest)) * (1 + _ROUNDING) >= least)
        score = self.vectors.scores(maybe + self.first, terms)
        found = score >= least
        return maybe[found], score[found]


def _search(vectors: DataFrame, items: Items, k: int, longest_only: bool, bucket: int = BUCKET_DOCS) -> DataFrame:
    """``(item, doc_id, tie, score)``: of each task at most ``k`` documents an item, those that reach its ``least``."""
    shared = vectors.sparkSession.sparkContext.broadcast(items)  # one block of items
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("score", pa.int64())])

    def some(batches) -> Iterator[pa.Table]:
        held, entries = [], 0
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
            held.append(batch)
            entries += len(batch.column("terms").flatten())
            if entries >= TASK_ENTRIES:
                yield pa.Table.from_batches(held)
                held, entries = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        asked: Items = shared.value
        rarest_first = [t[np.argsort(-asked.weights[t], kind="stable")] for t in asked.terms]
        length2 = np.array([float(asked.weights[t].sum()) for t in asked.terms])
        least = asked.least.copy()  # rises with what this task has found
        for rows in some(batches):
            rows = rows.combine_chunks()
            if not rows.num_rows:
                continue
            lists = rows.column("terms").chunk(0)
            starts = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).astype(np.int64)
            vectors_ = Vectors(asked, starts, lists.flatten().to_numpy().astype(np.int64),
                               rows.column("counts").chunk(0).flatten().to_numpy().astype(np.int64),
                               rows.column("n").to_numpy(), bucket)
            ids, tie = rows.column("doc_id"), rows.column("tie").to_numpy()
            place = np.empty(rows.num_rows, dtype=np.int64)  # equal scores go by id, null last
            place[np.lexsort((tie, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))] = np.arange(rows.num_rows)
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for b in vectors_.buckets():
                for item in b.reachable(length2, least).tolist():
                    found, score = b.search(rarest_first[item], int(least[item]))
                    if not len(found):
                        continue
                    row = vectors_.order[found + b.first]
                    if item in best:
                        row, score = np.concatenate([best[item][0], row]), np.concatenate([best[item][1], score])
                    first = np.lexsort((place[row], -score))[:k]
                    best[item] = row[first], score[first]
                    if len(first) == k:
                        least[item] = max(least[item], score[first[-1]])
                if longest_only:
                    break
            if best:
                row = np.concatenate([r for r, _ in best.values()])
                yield common.out_batch(
                    schema, np.repeat(np.array(list(best), dtype=np.int32), [len(r) for r, _ in best.values()]),
                    ids.combine_chunks().take(pa.array(row)), tie[row], np.concatenate([s for _, s in best.values()]))

    return vectors.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "tie")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rank_block(docs: DataFrame, ids: list, items: Items, k: int) -> DataFrame:
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}"
    _vectors(docs, items.names).write.parquet(folder)  # read three times below
    vectors = spark.read.parquet(folder)
    items.weigh(*_corpus(vectors, len(items.names)))
    for r in _ranked(_search(vectors, items, k, longest_only=True), k).where(F.col("rank") == k).select(
            "item", "score").collect():  # one row an item of the block
        items.least[r.item] = max(r.score, 1)
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    out = common.cut(_ranked(_search(vectors, items, k, longest_only=False), k)
                     .join(F.broadcast(names), "item")  # one block of items
                     .select("item_id", "rank", "doc_id", "score"))
    common.remove_folder(spark, folder)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items`` (``item_id``, ``text``) the ``k`` documents of
    ``docs`` (``doc_id``, ``text``) with the highest scores above 0 (all, if fewer), equal scores by ascending id.

    Null and empty texts have no terms: such documents are not counted, such items find nothing. Equal rows of
    ``items`` ask once; rows with equal id and other texts are items of their own. Equal ids of documents go by
    the hash of their texts, null ids last; equal documents are each ranked. Scores must fit 63 bits. Empty tables
    give no row.
    """
    common.ship_package(docs.sparkSession)
    asked = common.cut(_item_terms(items))
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(-(-total // block_terms), 1)
    out = None
    for b in range(blocks):  # each block is at most about BLOCK_TERMS terms
        rows = asked.where(F.size("terms") > 0).where(common.hash_bucket(blocks, F.col("item_id"), F.col("tie")) == b).collect()
        found = _rank_block(docs, [r.item_id for r in rows], Items.of([r.terms for r in rows]), k)
        out = found if out is None else out.unionByName(found)
    return out


#: The same in plain SQL, scoring every document that shares a term.
ORACLE_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    i AS (SELECT DISTINCT item_id, text, unnest(list_distinct(regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term FROM benchmark),
    c AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
    tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d)
           WHERE term IN (SELECT term FROM i) GROUP BY ALL),
    wt AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, nd),
    s AS (SELECT item_id, i.text, rid, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
          FROM i JOIN tf USING (term) JOIN wt USING (term)
          JOIN (SELECT rid, 50 + (50 * len(w) * nd) // total AS m FROM d, c WHERE len(w) > 0) USING (rid)
          GROUP BY item_id, i.text, rid)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
        SELECT item_id, doc_id, score,
               row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
        FROM s JOIN d USING (rid) WHERE score > 0)
    WHERE rank <= {K}
"""
