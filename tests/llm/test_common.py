import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulse.llm import common


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    least = {}
    for x in list(parent):
        least[find(x)] = min(least.get(find(x), x), x)
    return {x: least[find(x)] for x in parent}


def shapes():
    rng = random.Random(3)
    ids = rng.sample(range(-1000, 1000), 130)
    yield list(zip(ids, ids[1:]))                                    # a long path in no order
    yield [(5, x) for x in range(200, 400)] + [(399, 400), (401, 400)]  # a star with a tail
    yield [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    yield [(7, 7), (8, 9), (9, 8), (8, 9)]                            # loops and repeats


@pytest.mark.parametrize("edges", list(shapes()), ids=["path", "star", "random", "repeats"])
def test_components(spark, edges):
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: c for x, c in brute([e for e in edges if e[0] != e[1]]).items()}


def test_no_edges(spark):
    assert common.components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_every_pair_of_a_split_group_meets_in_one_bounded_cell(spark):
    rows = spark.range(300).select(F.when(F.col("id") < 250, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("m"))
    cells = {}
    for r in common.split_hot_groups(rows, ["k"], F.col("m"), 40).collect():
        cells.setdefault((r.k, r.cell_lo, r.cell_hi), set()).add(r.m)
    assert max(map(len, cells.values())) <= 2 * 60
    met = {(a, b) for (k, *_), ms in cells.items() if k == 1 for a in ms for b in ms}
    assert {(a, b) for a in range(250) for b in range(250)} <= met


def test_runs_reach_over_batches():
    keys = [1, 1, 2, 2, 2, 3, 4, 4, 4, 4, 5]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64())], names=["k"]) for a, b in ((0, 4), (4, 4), (4, 8), (8, 11))]
    groups = []
    for rows, starts in common.sorted_runs(iter(batches), ["k"]):
        ks = rows.column("k").to_pylist()
        ends = list(starts) + ([len(ks)] if starts[-1] != len(ks) else [])
        groups += [ks[a:b] for a, b in zip(ends, ends[1:])]
    assert groups == [[1, 1], [2, 2, 2], [3], [4, 4, 4, 4], [5]]


def test_parts_are_cut_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 5, None, "b" * 30, "", "c"])], names=["text"])
    assert [p.column("text").to_pylist() for p in common.parts(batch, size=10)] == [["a" * 5, None], ["b" * 30], ["", "c"]]
