import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulse.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    sound = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(-(-max((len(v) for _, v, _ in sound), default=0) // parts), 1)
    sound = [(i, v + [0] * (parts * width - len(v)), y) for i, v, y in sound]
    cut = lambda v, p: v[p * width: p * width + width]
    first = sorted(sound, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        got = [[[] for _ in b] for b in books]
        for _, v, _ in sound:
            for p in range(parts):
                got[p][nearest(v, p)[1]].append(cut(v, p))
        books = [[[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(got[p], books[p])] for p in range(parts)]
    mark = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded = [(i, [nearest(v, p) for p in range(parts)], y) for i, v, y in sound]
    by_label = {}
    for _, n, y in coded:
        by_label[y] = by_label.get(y, 0) + sum(d for d, _ in n)
    return sorted(((i, "".join(f"{k:02x}" for _, k in n), sum(d for d, _ in n), by_label[y], mark) for i, n, y in coded), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def vectors(n, dims, seed, scale=0.2):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, scale, dims).tolist(), int(i % 3) if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("n,dims", [(400, 32), (90, 16), (30, 48), (1, 16)])
def test_against_brute_force(spark, n, dims):
    rows = vectors(n, dims, n)
    assert got(vc.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_ties_and_common_vectors(spark):
    """A vector that many rows share, also among the first rows, so that entries are equal."""
    rows = [(i, [0.5] * 16 if i % 2 else v, y) for i, v, y in vectors(200, 16, 9)]
    rows += [(1000 + i, [0.5] * 16, 1) for i in range(300)]
    assert got(vc.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_nulls_lengths_repeats_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0, 3.0], 1), (1, [], None), (2, None, 1), (3, [nan] * 16, 1), (4, [1.0, None], 1), (5, [inf], 1),
            (6, [0.1] * 20, 2), (6, [0.1] * 20, 2), (None, [0.25] * 16, None), (None, [-0.25] * 16, None)]
    frame = spark.createDataFrame([(*r, 1, "q") for r in rows], SCHEMA + ", error int, q string")
    assert got(vc.compress(frame)) == brute(rows)
    assert vc.compress(frame.limit(0)).collect() == []
    assert vc.compress(frame.where("vec_id = 2")).collect() == []
    unlabelled = [(i, v, None) for i, v, _ in rows]
    assert got(vc.compress(frame.drop("label"))) == brute(unlabelled)


def test_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(vc, "BLOCK_ROWS", 50)
    rows = vectors(333, 16, 5)
    assert got(vc.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 300), st.integers(1, 64), st.integers(1, 5), st.integers(1, 40), st.integers(0, 10**6))
def test_trees_assign_as_all_pairs_do(n, m, width, spread, seed):
    rng = np.random.default_rng(seed)
    parts = rng.integers(-spread, spread + 1, (3, n, width))
    books = rng.integers(-spread, spread + 1, (3, m, width))
    apart = ((parts[:, :, None] - books[:, None]) ** 2).sum(axis=3)
    made = vc.Assignment(parts, books)
    want = apart.argmin(axis=2)
    assert (made.nearest(n) == want).all()
    count, total = made.sums()
    for p in range(3):
        assert (count[p] == np.bincount(want[p], minlength=m)).all()
        for e in range(m):
            assert (total[p, e] == parts[p][want[p] == e].sum(axis=0)).all()


def test_whole_nodes_are_assigned_at_once():
    rng = np.random.default_rng(2)
    middles = rng.integers(-1000, 1000, (2, 64, 4)) * 100
    parts = np.concatenate([middles + rng.integers(-3, 4, middles.shape) for _ in range(60)], axis=1)
    made = vc.Assignment(parts, middles)
    whole = sum(int(made.parts.count[level][at, x].sum()) for level, at, x, _ in made.whole)
    assert whole > parts.shape[1]  # of both positions, more than half without looking at a part
