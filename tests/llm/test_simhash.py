import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulse.llm import simhash

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [words] if len(words) < 4 else [words[i: i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, max_bits=4):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                parent[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def result(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def texts(seed, n):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = [f"w{k}" for k in rng.integers(0, 400, int(rng.integers(1, 60)))]
        out.append(" ".join(words))
        for _ in range(int(rng.integers(0, 4))):  # near copies
            near = list(words)
            near[int(rng.integers(0, len(near)))] = "Changed"
            out.append("\n".join(near))
    return out


def test_matches_brute_force(spark):
    rows = [(10 + 3 * i, t) for i, t in enumerate(texts(1, 120) + ["", None, "A", "a", " \t"])]
    got = result(simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    fps = [brute_fingerprint(t) for _, t in rows]
    classes = brute_components([i for i, _ in rows], fps)
    assert got == {i: (f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, classes)}


def test_same_hash_as_spark(spark):
    df = spark.createDataFrame([(1, "one two Three four")], SCHEMA)
    h = df.select(F.xxhash64(F.lower("text"))).first()[0]
    assert brute_fingerprint("one two Three four") == h % 2**64


def test_every_linked_pair_shares_an_anchor():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 300).astype(np.uint64)
    y = x.copy()
    for i in range(300):
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    for a, b in zip(x, y):
        rows, keys = simhash.anchors(np.array([a, b], dtype=np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_split_groups_lose_no_link(spark):
    """A large group of near copies under a small group limit, so it is cut into cells."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 300, 250)]
    rows = []
    for i in range(150):
        words = list(base)
        words[int(rng.integers(0, 250))] = f"x{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(simhash.near_duplicates(df, group_limit=10))
    fps = [brute_fingerprint(t) for _, t in rows]
    classes = brute_components([i for i, _ in rows], fps)
    assert {i: c for i, (_, c) in got.items()} == dict(zip(range(150), classes))


def test_chain_is_one_component():
    """Links reach along chains, not only from one member."""
    fp = np.array([0, 0b1111, 0b11111111, 0b111111111111], dtype=np.uint64)
    links = simhash._links_of_group(fp, 4)
    assert len(links) == 3


def test_empty_repeated_null_ids_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    rows = [(7, "a b c d e", "x", 1), (7, "a b c d e", "y", 2), (None, "a b c d e", "z", 3),
            (None, "quite another text here", "z", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sorted(simhash.near_duplicates(df).select("doc_id", "component_id").collect(), key=str)
    assert [(r.doc_id, r.component_id) for r in got] == [(7, 7), (7, 7), (None, 7), (None, None)]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.text) for r in kept.collect()) == [
        (False, "a b c d e"), (True, "quite another text here")]


def test_long_text_in_chunks(spark, monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 1000)
    assert simhash.text_fingerprint(text.encode()) == brute_fingerprint(text)


def test_rejects_wider_thresholds(spark):
    with pytest.raises(ValueError):
        simhash.near_duplicates(spark.createDataFrame([], SCHEMA), max_bits=5)


def test_keep_first_goes_by_rows(spark):
    """Two texts under one id are two documents; rows without an id are compared too; equal rows count once."""
    one, two, three = ("one two three four five six seven", "other words that have nothing in common with it", "a third text of its own kind here")
    rows = [(1, one, "a"), (1, two, "a"), (2, one, "b"), (None, three, "a"), (None, three, "a"), (None, three, "b"), (None, two, "c"),
            (3, three, "z"), (5, None, "a"), (4, "", "a"), (None, None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = sorted(map(tuple, simhash.keep_first(df).collect()), key=str)
    assert got == sorted([(1, one, "a"), (1, two, "a"), (3, three, "z"), (4, "", "a")], key=str)
    nameless = df.where("doc_id is null and text is not null")
    kept = simhash.keep_first(nameless).collect()
    assert sorted(r.text for r in kept) == sorted([two, three]) and all(r.doc_id is None for r in kept)
    again = simhash.keep_first(nameless.repartition(5)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, kept), key=str)
