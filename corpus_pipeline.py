"""Corpus pipeline: from raw documents to training tokens.

Quality classifier, SimHash near-dedup, PII, mixing of sources, byte-level BPE. Each
stage takes what the one before kept, as Parquet, and returns the columns of
``documents`` (the last: one row per document copy with its tokens' digests).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pulse.llm import bpe, mixing, pii, quality_crf, simhash
from pulse.llm.common import table
from pulse.llm.queries import PII_KEY
from pulse.session import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id."""
    return simhash.keep_first(docs)


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Valid personal values in the texts become pseudonyms."""
    return pii.with_pseudonyms(docs, PII_KEY, found="_n_found").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.apply_mix(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document copy."""
    return bpe.digests(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pii_pseudonyms", pii_pseudonyms),
    ("source_mixing", source_mixing),
    ("bpe_tokens", bpe_tokens),
]

#: The stages learn, hash and tokenise, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written to the shared
    folder as Parquet and read back, so a lost executor never costs an earlier stage."""
    root = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
