import hashlib
from collections import Counter

import tiktoken
import pytest

import corpus_pipeline
from pulse.llm import bpe, mixing, pii, quality_crf, queries, simhash, vocab

from tests.conftest import SF

DIR = SF["0.001"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Each stage's rows, written and read back as ``run`` does."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_the_columns(staged):
    for df in staged[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage_drops_what_the_classifier_rejects(spark, staged):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    good = {r.doc_id for r in quality_crf.quality(staged[0], labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in staged[1].collect()} == good
    assert 0 < len(good) < staged[0].count()


def test_dedup_stage_keeps_one_of_each_component(staged):
    classes = simhash.near_duplicates(staged[1]).collect()
    assert {r.doc_id for r in staged[2].collect()} == {r.component_id for r in classes}
    assert staged[2].count() < staged[1].count()


def test_pii_stage_changes_only_values(staged):
    before = {r.doc_id: r.text for r in staged[2].collect()}
    found = {r.doc_id: r for r in pii.pseudonymise(staged[2], queries.PII_KEY).collect()}
    after = {r.doc_id: r.text for r in staged[3].collect()}
    assert after == {i: r.text for i, r in found.items()}
    assert all((after[i] != before[i]) == (found[i].n_found > 0) for i in before)


def test_mixing_stage_repeats_documents(staged):
    want = Counter({r.doc_id: r.copies for r in mixing.mix(staged[3]).collect() if r.copies})
    assert Counter(r.doc_id for r in staged[4].collect()) == want


def test_tokens_of_every_copy(staged):
    with open(bpe.VOCABULARY, "rb") as f:
        ranks = vocab.read_ranks(f.read())
    theirs = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in staged[4].collect():
        ids = theirs.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in staged[5].collect()) == want


def test_run_gives_the_last_stage(spark, staged):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, DIR).collect())
    assert got == sorted(tuple(r) for r in staged[5].collect())


def test_no_rows(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.collect() == []


def test_odd_rows_from_end_to_end(spark, tmp_path):
    """Nulls in any column, repeated rows and ids, a very long text, and columns of the operators' own names."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    sample = docs.limit(40).collect()
    odd = [(None, None, None, None, None), (None, "", "en", None, 0), (9001, None, "en", "web", 0), (9002, "word " * 100_000, "en", "web", 500_000),
           (9003, "first text of this id, which is about one thing", "en", None, 1), (9003, "second text under the same id, on something else", "en", None, 1)]
    rows = [tuple(r) + ("x", 1) for r in sample + sample[:5]] + [r + ("x", 1) for r in odd + odd[:1]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, copies int"
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{DIR}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, folder).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        if name != "bpe_tokens":
            assert after.columns == now.columns
        if name == "simhash_near_dedup":
            texts = [r.text for r in after.collect()]
            assert len(texts) == len(set(texts)) and sum("id" in (t or "") and "text" in (t or "") for t in texts) >= 2
        now = after
    last = now.collect()
    assert last and all(r.n_tokens > 90_000 for r in last if r.doc_id == 9002)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str) == sorted(map(tuple, last), key=str)
