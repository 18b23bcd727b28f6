import math

import numpy as np
import pytest

from pulse.llm import topk

from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every=50, k=5):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in sound:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i)
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


def got(df):
    rows = df.collect()
    out = {(r.query_id, r.rank, r.vec_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def vectors(n, dims, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (np.float32(scale) * rng.normal(size=dims).astype(np.float32)).tolist()) for i in range(n)]


@pytest.mark.parametrize("n,dims,scale", [(300, 8, 1.0), (130, 3, 0.01), (64, 5, 40.0)])
def test_against_brute_force(spark, n, dims, scale):
    rows = vectors(n, dims, n, scale)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(topk.search(df, query_every=10, block_rows=40, block_queries=7)) == brute(rows, 10)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [0.5, 0.5]) for i in range(0, 400)]  # one very common vector
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(topk.search(df, block_rows=30)) == brute(rows)


def test_unsound_vectors_few_rows_and_lengths(spark):
    rows = [(0, [1.0, -2.0, 3.0]), (1, [1.0]), (2, None), (3, [float("nan"), 1.0, 1.0]), (4, [None, 1.0, 1.0]),
            (5, [float("inf")]), (50, [-1.0, 0.5, 2.0, 9.0]), (100, []), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA + ", score int")
    assert got(topk.search(df)) == brute(rows)
    assert topk.search(df.limit(0)).collect() == []
    assert topk.search(df.where("vec_id = 0")).collect() == []


def test_repeated_rows(spark):
    rows = [(0, [1.0, 2.0])] * 2 + [(1, [1.0, 2.0])] * 3 + [(2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted((r.query_id, r.rank, r.vec_id) for r in topk.search(df).collect())
    assert out == [(0, 1, 1), (0, 2, 1), (0, 3, 1), (0, 4, 2)]


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF['0.001']}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(topk.search(df, block_rows=128)) == brute(rows)
