"""Bounded training samples: labelled documents whose id falls outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    limit: int) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``limit`` labelled documents outside the held-out fold.

    Those with the smallest id hashes are taken, so the sample depends on nothing else and
    is spread over all sources. An id with several labels counts as 1 if any is; an id with several
    texts gives one of them. Labels other than 0 and 1 are left out.
    """
    doc_id = F.col("doc_id").cast("long")
    known = (labels.select(doc_id.alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
             .where(fold(F.col("doc_id"), folds) != held_out)
             .groupBy("doc_id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most ``limit`` rows of an id and a bit: safe to broadcast whatever the input's size.
    return rows.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(
        F.max("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
