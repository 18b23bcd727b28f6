import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulse.llm import mixing

from tests.conftest import SF

SCHEMA = "doc_id long, text string, source string"


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare the excess until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        over = sum(weight[s] for s in names if s not in full)
        goal = {s: most * sizes[s] if s in full else rest * weight[s] / over for s in names}
        above = {s for s in names if s not in full and goal[s] > most * sizes[s] * (1 + 1e-12)}
        if not above:
            return goal
        full |= above


def check(rows, got, tolerance=0.5):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    goal = brute_targets(sizes) if sizes else {}
    taken, largest = defaultdict(int), defaultdict(int)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted(
        (str(i), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in rows)
    for r in got:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source], rel=1e-9, abs=1e-9)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= tolerance * largest[s] + 1e-6


def docs(n, sources=5):
    return [(i, "w " * (1 + (i * 37) % 50), f"s{i * i % sources}") for i in range(n)]


def test_targets_and_words(spark):
    rows = docs(700) + [(1000 + i, "x y z", None) for i in range(9)] + [(2000, None, "empty"), (2001, "", "empty")]
    check(rows, mixing.mix(spark.createDataFrame(rows, SCHEMA), leaf=8).collect())


def test_hot_source_through_a_deep_tree(spark):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else "b") for i in range(3000)] + [(9000, "a b", "c")]
    check(rows, mixing.mix(spark.createDataFrame(rows, SCHEMA), leaf=4).collect())


def test_reruns_agree_however_rows_are_split(spark):
    df = spark.createDataFrame(docs(400), SCHEMA)
    one = sorted(mixing.mix(df.repartition(7)).collect(), key=lambda r: r.doc_id)
    two = sorted(mixing.mix(df.coalesce(1)).collect(), key=lambda r: r.doc_id)
    assert one == two


def test_expected_copies_are_kept(spark):
    """Over many seeds a document's mean copies come near its source's rate."""
    df = spark.createDataFrame([(i, "w " * (1 + i % 3), "a" if i < 96 else "b") for i in range(240)], SCHEMA).cache()
    runs = 4
    total = defaultdict(int)
    for seed in range(runs):
        for r in mixing.mix(df, seed=seed, leaf=16).where("source = 'b'").collect():
            total[r.size] += r.copies
            rate = r.target / r.source_size
    for size, copies in total.items():
        assert copies / (48 * runs) == pytest.approx(rate, abs=0.2)


def test_repeated_rows_empty_table_and_clashing_columns(spark):
    rows = [(1, "a b c", "s", 9)] * 5 + [(None, "a", "s", 1)] * 2 + [(2, "one two", "t", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    check([r[:3] for r in rows], mixing.mix(df).collect())
    assert mixing.mix(df.limit(0)).collect() == []
    out = mixing.apply_mix(df)
    assert out.columns == df.columns
    want = mixing.mix(df).agg(F.sum("copies")).first()[0]
    assert out.count() == want
    assert mixing.apply_mix(df.limit(0)).collect() == []


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    check(rows, mixing.mix(df).collect())
    assert "Python" not in mixing.mix(df)._jdf.queryExecution().toString()


def test_many_sources_are_numbered_in_order(spark):
    """More sources than a range partition holds, with caps that fill up in several steps."""
    rows = [(i, "w " * (1 + i * i % 97), f"s{i * 7919 % 301:04d}") for i in range(1500)] + [(9000, "big " * 40_000, "s0000")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    got = mixing.mix(df, leaf=8).collect()
    check(rows, got)
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(4), leaf=8).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_very_long_text_and_very_many_copies(spark):
    rows = [(1, "word " * 300_000, "a"), (2, None, "a")] + [(3, "x y", "b")] * 9000 + [(4, "z", None)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, mixing.mix(df).collect())
