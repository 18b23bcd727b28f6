"""Mixing sources to target weights by pivotal dependent rounding.

Each document has an expected number of copies, its source's target over its
source's size. The whole part is taken; the fractional parts of a source are
rounded together. Two documents duel: copy probability moves between them, words
kept in balance, until one of them is 0 or 1; which way is drawn so that neither's
expectation changes. The survivor goes on to the next duel. Documents are dealt
by hash into leaves of about ``LEAF`` units, each leaf leaves one undecided unit, and those are
combined ``LEAF`` at a time up a tree whose height grows with the logarithm of the
largest source. Every level is one aggregation whose groups are bounded, so a source
with a third of all rows is as many groups as it needs.

Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import WORD, cut

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
LEAF = 128
SEED = 20240817
#: Copies of a repeated row that are told apart in one array.
_COPIES = 4096

_UNIT = "struct<doc_id:bigint,occ:bigint,size:double,p:double>"
_DONE = "array<struct<doc_id:bigint,size:bigint,extra:int>>"


def text_size(text="text"):
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add to ``(source, source_size)`` each source's ``target`` words and its order ``src``.

    Sources weigh ``weights`` in turn, in code-point order with null last, and share
    the total of all sizes. A target stops at ``max_repeat`` times its source's size and
    the excess goes to the others by weight: what a unit of weight gets rises as sources fill up, which a few aggregates
    over the sources find. Sums are of integers, so reruns agree. Sources are numbered by ranges, so no task holds them all.
    """
    by_name = F.col("source").asc_nulls_last()
    ranged = cut(sizes.repartitionByRange(by_name).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    src = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("src") - 1) % len(weights) + 1).cast("int"))
    ranked = cut(ranged.join(F.broadcast(offsets), "_part").withColumn("src", src).withColumn("weight", weight)
                 .withColumn("_cap", F.col("source_size") * F.lit(max_repeat))
                 .select("src", *sizes.columns, "weight", "_cap"))
    ratio = F.col("_cap") / F.col("weight")
    total, open_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    full, level = 0, math.inf
    while open_weight:  # the level rises until no further source is full
        level = float(total - full) / float(open_weight)
        now = ranked.agg(F.sum(F.when(ratio < level, F.col("_cap"))), F.sum(F.when(ratio >= level, F.col("weight")))).first()
        if (now[0] or 0, now[1]) == (full, open_weight):
            break
        full, open_weight = now[0] or 0, now[1]
    else:
        level = math.inf  # all are full
    return (ranked.withColumn("target", F.when(ratio < level, F.col("_cap").cast("double"))
                              .otherwise(F.least(F.col("weight") * F.lit(level), F.col("_cap").cast("double"))))
            .select("src", *sizes.columns, "weight", "target"))


def _duels(seed: int):
    """SQL over ``xs`` (a leaf's units in random order): ``struct(carry, done)``."""
    first = f"named_struct('carry', xs[0], 'done', cast(array() as {_DONE}))"
    # a: survivor, b: next unit, m: words of b for a word of a; up: how far a can rise, dn: fall.
    moves = ("named_struct('a', acc.carry, 'b', x, 'm', x.size / acc.carry.size, "
             "'up', least(1 - acc.carry.p, x.p * x.size / acc.carry.size), "
             "'dn', least(acc.carry.p, (1 - x.p) * x.size / acc.carry.size), "
             f"'u', pmod(xxhash64({seed}L, acc.carry.doc_id, acc.carry.occ, x.doc_id, x.occ), 1048576) / 1048576D)")
    drawn = ("named_struct('a', s.a, 'b', s.b, "
             "'pa', case when s.u * (s.up + s.dn) < s.dn "
             "then if(1 - s.a.p <= s.b.p * s.m, 1D, s.a.p + s.up) "
             "else if(s.a.p <= (1 - s.b.p) * s.m, 0D, s.a.p - s.dn) end, "
             "'pb', case when s.u * (s.up + s.dn) < s.dn "
             "then if(1 - s.a.p <= s.b.p * s.m, greatest(s.b.p - s.up / s.m, 0D), 0D) "
             "else if(s.a.p <= (1 - s.b.p) * s.m, least(s.b.p + s.dn / s.m, 1D), 1D) end)")
    a_done = "(r.pa = 0D or r.pa = 1D)"
    step = (f"named_struct('carry', if({a_done}, "
            "named_struct('doc_id', r.b.doc_id, 'occ', r.b.occ, 'size', r.b.size, 'p', r.pb), "
            "named_struct('doc_id', r.a.doc_id, 'occ', r.a.occ, 'size', r.a.size, 'p', r.pa)), "
            f"'done', concat(acc.done, array(if({a_done}, "
            "named_struct('doc_id', r.a.doc_id, 'size', cast(r.a.size as bigint), 'extra', cast(r.pa as int)), "
            "named_struct('doc_id', r.b.doc_id, 'size', cast(r.b.size as bigint), 'extra', cast(r.pb as int))))))")
    body = f"transform(transform(array({moves}), s -> {drawn}), r -> {step})[0]"
    return F.expr(f"aggregate(slice(xs, 2, greatest(size(xs) - 1, 0)), {first}, (acc, x) -> {body})")


def _combine(units: DataFrame, leaf_key: str, seed: int) -> DataFrame:
    """One level: the units of each (src, leaf) duel in hash order."""
    order = F.xxhash64(F.lit(seed), F.col("unit.doc_id"), F.col("unit.occ"))
    return cut(units.groupBy("src", leaf_key).agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), "unit"))).alias("xs"))
        .withColumn("xs", F.transform("xs", lambda x: x["unit"]))
        .withColumn("r", _duels(seed)).select("src", leaf_key, "r"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT,
        seed: int = SEED, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source``): ``doc_id``, ``size``
    (words), ``source_size``, ``target`` (its source's), ``taken`` (``size * copies``), ``source``, ``copies`` (0 to
    ``max_repeat``).

    A source's taken words miss its target by at most half the words of the one document left at the
    root, which is rounded to the nearer side. Draws are hashes of the seed and the
    ids, so reruns agree however the rows are split. Null text has size 0; a null source is a
    source of its own, last in order. Documents without words take none: their
    ``copies`` is the whole part of their source's rate. Repeated rows are units of their own (equal
    rows are interchangeable). An empty table gives no row.
    """
    sized = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), text_size().alias("size"))
    # Equal rows are counted before the shuffle and told apart by their number afterwards.
    rows = cut(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    per_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                            F.sum("n").alias("units"))
    goal = cut(
        targets(per_source, weights, max_repeat)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("rate").cast("int"))
        .withColumn("part", F.col("rate") - F.floor("rate"))
        .withColumn("leaves", F.ceil(F.col("units") / leaf)))
    units = (rows.join(goal.select(F.col("source").alias("_s"), "src", "part", "leaves"),
                       F.col("source").eqNullSafe(F.col("_s")))
             .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES))))
             .withColumn("occ", F.explode(F.sequence(F.col("_block") * _COPIES + 1,
                                                     F.least((F.col("_block") + 1) * _COPIES, F.col("n"))))))
    contest = (F.col("size") > 0) & (F.col("part") > 0)
    still = units.where(~contest).select("src", "doc_id", "size", F.lit(0).alias("extra"))
    level = _combine(
        units.where(contest).select(
            "src", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "occ"), F.col("leaves")).alias("leaf"),
            F.struct("doc_id", "occ", F.col("size").cast("double").alias("size"),
                     F.col("part").alias("p")).cast(_UNIT).alias("unit")), "leaf", seed)
    decided = [still]
    widest = goal.agg(F.max("leaves")).first()[0] or 1  # one number: the tree's width
    while True:
        decided.append(level.select("src", F.explode("r.done").alias("d")).select("src", "d.*"))
        if widest <= 1:
            break
        widest = -(-widest // leaf)
        level = _combine(level.select("src", F.floor(F.col("leaf") / leaf).alias("leaf"),
                                      F.col("r.carry").alias("unit")), "leaf", seed)
    decided.append(level.select("src", "r.carry.*").select(
        "src", "doc_id", F.col("size").cast("long"), F.when(F.col("p") >= 0.5, 1).otherwise(0).alias("extra")))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    copies = F.col("whole") + F.col("extra")
    return out.join(goal, "src").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "source", copies.alias("copies"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it (0 times: gone).

    Rows equal in (``doc_id``, ``source``, size) share their copies: the first of them, in the
    order of their texts' hashes, take the larger number.
    """
    share = mix(docs, **options).groupBy("doc_id", "source", "size").agg(
        F.min("copies").alias("_least"), F.sum(F.col("copies")).alias("_all"), F.count(F.lit(1)).alias("_n"))
    share = share.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"),
                         "_least", (F.col("_all") - F.col("_least") * F.col("_n")).alias("_extra"))
    names = docs.columns
    sized = docs.withColumn("_size", text_size())
    joined = sized.join(share, F.col("doc_id").cast("long").eqNullSafe(F.col("_d"))
                        & F.col("source").cast("string").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")))
    number = F.row_number().over(Window.partitionBy("_d", "_s", "_z").orderBy(F.xxhash64("text")))
    return (joined.withColumn("_copies", F.col("_least") + (number <= F.col("_extra")).cast("int"))
            .where("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select(*names))
