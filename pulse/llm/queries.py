"""Registered queries of the training-data operators: thin wrappers that apply each
operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulse.llm import (
    bpe,
    embedding_dedup,
    lexical,
    license_scan,
    mixing,
    packed_ids,
    pii,
    quality_crf,
    simhash,
    token_counts,
    topk,
    toxicity,
    vector_codes,
)
from pulse.llm.common import table

#: Key of the registered queries, which run on invented data; real jobs pass a secret of their own.
PII_KEY = "key of the registered queries"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings")).drop("query_hash")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids.round_trip(table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_topk": op7_topk,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_pii": op9_pii,
    "op10_packed_ids": op10_packed_ids,
    "op11_licenses": op11_licenses,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5
    """,
    "op8_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        e AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
            WHERE list_inner_product(a.x, a.x) > 0 AND list_inner_product(b.x, b.x) > 0
              AND list_inner_product(a.x, b.x)
                  / (sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))) >= 0.9),
        reached(a, b) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, e.b FROM reached r JOIN e ON r.b = e.a)
        SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM (
            SELECT m.vec_id, min(r.b) AS component_id,
                (SELECT count(*) FROM e WHERE e.a = m.vec_id) AS n_links
            FROM embeddings m JOIN reached r ON r.a = m.vec_id GROUP BY m.vec_id)
    """,
    "op11_licenses": license_scan.ORACLE_SQL,
    "op12_lexical_search": lexical.ORACLE_SQL,
    "op13_vector_codes": vector_codes.ORACLE_SQL,
}
