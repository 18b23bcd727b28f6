import math

import numpy as np
import pytest

from pulse.llm import embedding_dedup as ed

from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, threshold=0.9):
    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)

    ids = [i for i, _ in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if sound(v) else None for _, v in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and (
                    unit[i] @ unit[j] >= threshold):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, links[k], least[find(k)], i == least[find(k)]) for k, i in enumerate(ids))


def got(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(tuple(r) for r in df.collect())


def clustered(n, dims, seed, noise=0.15):
    """Groups around centres; cosines within a group spread around the threshold."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = rng.normal(size=dims)
        centre /= np.linalg.norm(centre)
        for _ in range(int(rng.integers(1, 20))):
            v = centre + noise * rng.uniform(0, 1) * rng.normal(size=dims) / math.sqrt(dims) * 3
            rows.append((3 * len(rows) + 1, v.astype(np.float32).tolist()))
    return rows


def test_recall_and_exactness(spark):
    rows = clustered(500, 24, 1)
    want, have = brute(rows), got(ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    total, found = sum(r[1] for r in want), sum(r[1] for r in have)
    assert total > 500 and 0.99 * total <= found <= total
    assert all(a[1] >= b[1] for a, b in zip(want, have))


def test_recall_at_64_dimensions(spark):
    rows = clustered(1500, 64, 7, noise=0.2)
    want, have = brute(rows), got(ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    total, found = sum(r[1] for r in want), sum(r[1] for r in have)
    assert total > 1000 and 0.99 * total <= found <= total
    assert all(a[1] >= b[1] for a, b in zip(want, have))


def test_signs_made_again_are_those_of_the_buckets(spark):
    """A pair is counted once, although it meets in many tables."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=32)
    rows = [(i, (centre + 0.05 * rng.normal(size=32)).astype(np.float32).tolist()) for i in range(40)]
    assert got(ed.near_duplicates(spark.createDataFrame(rows, SCHEMA), recall=0.999999)) == brute(rows)


def test_close_groups_are_found_whole(spark):
    rows = clustered(400, 16, 2, noise=0.03)
    assert got(ed.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_large_groups_are_split_without_loss(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (np.ones(12) + 0.02 * rng.normal(size=12)).tolist()) for i in range(150)]
    rows += [(1000 + i, rng.normal(size=12).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(ed.near_duplicates(df, group_limit=16)) == brute(rows)


def test_copies_and_unsound_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(5, 40)] + [(2, [2.0, 4.0]), (60, [-1.0, 0.0]), (61, [-1.0, -0.0])]
    rows += [(70, None), (71, [0.0, 0.0]), (72, [float("nan"), 1.0]), (73, [None, 1.0]), (74, []), (75, [1.0, 2.0, 0.0]),
             (76, [float("inf"), 1.0]), (5, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], SCHEMA + ", component_id int")
    want = brute([(i, v) for i, v in rows if v is None or len(v) != 0] + [(74, None)])
    assert got(ed.near_duplicates(df)) == want
    assert got(ed.near_duplicates(df.limit(0))) == []


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF['0.001']}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(ed.near_duplicates(df)) == brute(rows)


@pytest.mark.parametrize("nodes", [0, 1, 10_000, 10**9])
def test_plan_reaches_its_recall(nodes):
    bits, tables = ed.plan(nodes)
    meet = (1 - math.acos(0.9) / math.pi) ** bits
    assert 1 - (1 - meet) ** tables >= 0.995
    assert bits <= 32
