import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulse.llm import packed_ids

from tests.conftest import SF


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packed_ids.VOCABULARY)  # with the library's defaults


def brute(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 15, 16, 17, 20, 31, 32])
def test_pack_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
        data = packed_ids.pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert packed_ids.unpack(data, bits, n).tolist() == ids.tolist()


@pytest.mark.parametrize("bits,block", [(16, 64), (17, 64), (13, 30)])
def test_random_access(bits, block):
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1 << bits, 1000).astype(np.uint32)
    sink = io.BytesIO()
    writer = packed_ids.ShardWriter(sink, bits, block)
    writer.add([5, None], [300, 0], ids[:300])
    writer.add([9], [700], ids[300:])
    assert writer.close() == (3, 1000)
    shard = packed_ids.ShardReader(pa.BufferReader(sink.getvalue()))
    assert shard.docs == [5, None, 9] and shard.starts.tolist() == [0, 300, 300, 1000]
    for a, z in ((0, 1000), (0, 1), (63, 65), (299, 640), (999, 1000), (10, 10)):
        assert shard.ids(a, z).tolist() == ids[a:z].tolist()


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in packed_ids.round_trip(docs).collect())
    assert got == brute(rows, tokenizer)


def test_special_strings_are_what_the_library_makes_of_them(spark, tokenizer):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  \n\n y", "<|endoftext", "|endoftext|>", " <|endoftext|>it's"]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    rows = list(enumerate(texts * 3))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in packed_ids.round_trip(df).collect()) == brute(rows, tokenizer)


def test_odd_rows(spark, tokenizer):
    rows = [(4, "a  b\n\n c <|endoftext|> d", 1), (2, None, 2), (3, "", 3), (9, "long " * 30000, 4), (None, "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    want = brute([(i, t) for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))], tokenizer)
    got = packed_ids.round_trip(df)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want
    assert packed_ids.round_trip(df.limit(0)).collect() == []
    twice = packed_ids.round_trip(df.where("doc_id = 4").unionByName(df.where("doc_id = 4"))).collect()
    assert sorted(r.start for r in twice) == [0, twice[0].n_tokens]
