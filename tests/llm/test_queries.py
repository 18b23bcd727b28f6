import pytest

from pulse.llm.queries import ORACLE, QUERIES
from pulse.plans.verify import compare

from tests.conftest import SF

#: Columns that the queries' results must have, in order; more may follow.
COLUMNS = {
    "op1_quality": ["doc_id", "held_out", "score", "predicted"],
    "op2_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_token_counts": ["doc_id", "n_tokens"],
    "op7_topk": ["query_id", "rank", "vec_id", "score"],
    "op8_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op9_pii": ["doc_id", "n_found", "text"],
    "op10_packed_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op11_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op12_lexical_search": ["item_id", "rank", "doc_id", "score"],
    "op13_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF["0.001"])
    assert set(COLUMNS[name]) <= set(df.columns)
    table = "embeddings" if name in ("op7_topk", "op8_embedding_dedup", "op13_vector_codes") else "documents"
    n = spark.read.parquet(f"{SF['0.001']}/{table}.parquet").count()
    if name == "op12_lexical_search":  # up to 50 an item
        items = spark.read.parquet(f"{SF['0.001']}/benchmark.parquet").count()
        assert items < df.count() <= 50 * items
        return
    assert df.count() == (n // 50 * 5 if name == "op7_topk" else n)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    r = compare(spark, QUERIES[name], ORACLE[name], SF["0.01"])
    assert r["ok"], r
