import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pulse.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    held = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, c, size in held:
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 12, 40])))) for i in range(n)]


@pytest.mark.parametrize("k,block_terms", [(5, 1 << 20), (50, 4), (1, 9)])
def test_against_brute_force(spark, k, block_terms):
    docs = corpus(300, 1)
    items = [(7 * i, t) for i, t in corpus(12, 2)]
    df = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k, block_terms)
    assert got(df) == brute(docs, items, k)


def test_terms_split_as_the_pattern_says(spark):
    docs = [(1, "A-b_c d'E"), (2, "É é ÀB"), (3, "a1 1a 1 a"), (4, "\x7f~`^[]@:/"), (5, "日本 日本語"), (6, "K K")]
    items = [(1, "a"), (2, "É"), (3, "1"), (4, "Àb à b"), (5, "日本"), (6, "k")]
    df = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert got(df) == brute(docs, items)


def test_many_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in range(400, 0, -1)] + [(i, "other text") for i in range(1000, 1100)]
    items = [(1, "words"), (2, "text words")]
    df = spark.createDataFrame(docs, DOCS).repartition(7)
    assert got(lexical.search(df, spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_nulls_repeats_empty_and_long(spark):
    docs = [(1, None), (2, ""), (3, "..."), (None, "x y"), (4, "x y"), (4, "x y"), (5, "x " * 200_000 + "z"), (None, None)]
    items = [(1, "x z"), (1, "x z"), (1, "y"), (None, "z"), (3, None), (4, ""), (5, "missing")]
    frame = spark.createDataFrame([(i, t, 1, "n") for i, t in docs], DOCS + ", score int, terms string")
    df = lexical.search(frame, spark.createDataFrame([(i, t, 2) for i, t in items], ITEMS + ", rank int"))
    assert got(df) == brute(docs, [i for i in items if i[1]])


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(corpus(5, 3), DOCS), spark.createDataFrame([(1, "w0 w1")], ITEMS)
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.withColumn("text", docs.text.substr(1, 0)), items).collect() == []


def test_bounds_prune_and_lose_nothing():
    """Buckets and documents that are passed over hold no score that reaches the threshold."""
    rng = np.random.default_rng(4)
    n, v = 4000, 200
    items = lexical.Items.of([[f"t{j:03d}" for j in rng.choice(v, 12, replace=False)] for _ in range(20)])
    lengths = rng.integers(1, 30, n)
    own = [np.sort(rng.choice(len(items.names), min(x, len(items.names)), replace=False)) for x in lengths]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in own])])
    of = np.concatenate(own)
    counts, sizes = rng.integers(1, 5, len(of)), lengths * 5
    items.weigh(n, int(sizes.sum()), np.bincount(of, minlength=len(items.names)))
    vectors = lexical.Vectors(items, starts, of, counts, sizes, 100)
    assert (np.diff(vectors.length2) <= 0).all()
    passed = 0
    for item, asked in enumerate(items.terms):
        asked = asked[np.argsort(-items.weights[asked], kind="stable")]
        scores = vectors.scores(np.arange(n), asked)
        least = int(np.sort(scores)[-10])
        found = set()
        for b in vectors.buckets():
            if not len(b.reachable(np.array([float(items.weights[asked].sum())]), np.array([least]))):
                passed += 1
                continue
            rows, s = b.search(asked, least)
            assert (scores[rows + b.first] == s).all()
            found |= set((rows + b.first).tolist())
        assert found == set(np.flatnonzero(scores >= least).tolist())
    assert passed > 0
