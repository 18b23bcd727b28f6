import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pulse.llm import bpe, token_counts, vocab

from tests.conftest import SF

SCHEMA = "doc_id long, text string"
ALPHABET = "abcdefgh  \n\t   ABC 123 .,!'s't \x1c\x85\xa0 ​é中文🙂ñß'll<|endoftext|>"


@pytest.fixture(scope="module")
def data():
    with open(bpe.VOCABULARY, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def ours(data):
    return bpe.Encoder(data)


@pytest.fixture(scope="module")
def theirs(data):
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=vocab.read_ranks(data), special_tokens={})


def test_random_texts(ours, theirs):
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60)))
        assert ours.encode(text) == theirs.encode_ordinary(text), repr(text)
        assert ours.decode(ours.encode(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(ours, theirs, text):
    assert ours.encode(text) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 20000, " " * 5000, "ab" * 3000, "\n" * 777, "thethe" * 500, "x" * 99 + " " * 99,
                                  "<|endoftext|>"])
def test_long_pieces(ours, theirs, text):
    assert ours.encode(text) == theirs.encode_ordinary(text)


def test_memo_limit_changes_nothing(data, theirs, monkeypatch):
    monkeypatch.setattr(vocab, "PIECE_ENTRIES", 3)
    monkeypatch.setattr(vocab.Memo, "_TURNS", 2)
    small = bpe.Encoder(data)
    text = "several words that fill the small memo many times over, again and again and again"
    for _ in range(5):
        assert small.encode(text) == theirs.encode_ordinary(text)


def test_query_on_whole_table(spark, theirs):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    want = {}
    for r in docs.collect():
        ids = theirs.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect()}
    assert got == want


def test_null_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None, 5), (2, "", 6), (2, "", 6), (None, "a b", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    encoded = bpe.encode(df)
    assert sorted((str(r.doc_id), len(r.ids)) for r in encoded.collect()) == [
        ("1", 0), ("2", 0), ("2", 0), ("None", 2)]
    assert sorted(bytes(r.decoded) for r in bpe.decode(encoded).collect()) == [b"", b"", b"", b"a b"]
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df.where("doc_id < 3")).collect()} == {(empty, empty)}
    assert bpe.digests(df.limit(0)).collect() == []


def brute_count(tokens, split, text):
    count = 0
    for piece in split(text):
        piece, at = piece.encode(), 0
        while at < len(piece):
            at = max(end for end in range(at + 1, len(piece) + 1) if piece[at:end] in tokens)
            count += 1
    return count


def test_counts_match_greedy_matching(data):
    counter, tokens = token_counts.Counter(data), vocab.read_ranks(data)
    rng = random.Random(9)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60)))
        assert counter.count(text) == brute_count(tokens, vocab.splitter(), text), repr(text)
    for text in ("a" * 3000, " " * 999, "thethe" * 200):
        assert counter.count(text) == brute_count(tokens, vocab.splitter(), text)


def test_counts_query(spark, data):
    counter, tokens = token_counts.Counter(data), vocab.read_ranks(data)
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet").limit(40)
    rows = docs.collect()
    got = {r.doc_id: (r.n_tokens, r.n_bytes) for r in token_counts.token_counts(docs).collect()}
    assert got == {r.doc_id: (brute_count(tokens, vocab.splitter(), r.text), len(r.text.encode())) for r in rows}
    odd = spark.createDataFrame([(1, None, 3), (1, "", 4), (None, "x y", 5)], "doc_id long, text string, n_tokens int")
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(odd).collect()) == [
        ("1", 0), ("1", 0), ("None", 2)]
    assert token_counts.token_counts(odd.limit(0)).collect() == []


def test_counter_needs_single_bytes():
    with pytest.raises(ValueError):
        token_counts.Counter(b"YQ== 0\n")
