import itertools
import math
import zlib

import numpy as np
import pytest

from pulse.llm import labelled, quality_crf as q

from tests.conftest import SF

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 8):
        unary, trans = rng.normal(size=n) * 2, rng.normal(size=4) * 2
        weight = {}
        for labels in itertools.product((0, 1), repeat=n):
            s = sum(u for u, y in zip(unary, labels) if y)
            s += sum(trans[2 * a + b] for a, b in zip(labels, labels[1:]))
            weight[labels] = math.exp(s)
        want = [sum(w for y, w in weight.items() if y[i]) / sum(weight.values()) for i in range(n)]
        assert q.marginals(unary.tolist(), tuple(trans)) == pytest.approx(want)


def test_training_pass_agrees_with_scoring():
    rng = np.random.default_rng(1)
    unary, trans = rng.normal(size=(3, 6)), rng.normal(size=(2, 2))
    mask = np.arange(6) < np.array([[6], [3], [1]])
    _, one, pairs = q._chain_pass(np.where(mask, unary, 0), mask, trans)
    for k, n in enumerate((6, 3, 1)):
        assert one[k, :n] == pytest.approx(q.marginals(unary[k, :n].tolist(), tuple(trans.reshape(-1))))
    assert pairs.sum() == pytest.approx(5 + 2 + 0)


def test_extreme_scores_do_not_overflow():
    out = q.marginals([900.0, -900.0, 900.0] * 50, (0.0, -800.0, -800.0, 0.0))
    assert all(0 <= p <= 1 for p in out)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF['0.1']}/documents.parquet")
    labels = spark.read.parquet(f"{SF['0.1']}/labels.parquet")
    rows = q.quality(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    good = [r for r in held if r.quality == 1]
    bad = [r for r in held if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.95 * len(bad)


def test_sample_never_holds_held_out_labels(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)] + [(3, "another text")], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(7, 0), (7, 1), (8, None), (None, 1), (9, 5)], LABELS)
    rows = labelled.training_sample(docs, labels, "quality", 5, 0, 50).collect()
    assert len(rows) == 50 and len({r.doc_id for r in rows}) == 50
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


GOOD_LINE = "The committee met on Tuesday and agreed on the plan for the coming year."
BAD_LINE = "$$$ WIN!!! ### click >>> |||| 000 ### $$$ !!!"


def test_bad_lines_far_into_a_long_document_are_learned(spark, monkeypatch):
    """Sampled documents are seen whole: what makes them bad may stand anywhere."""
    rows = [(k, "\n".join([GOOD_LINE + f" {n}" for n in range(8 + k % 5)])) for k in range(0, 60)]
    rows += [(k, "\n".join([GOOD_LINE + f" {n}" for n in range(300)] + [BAD_LINE + str(n) for n in range(60)])) for k in range(100, 160)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], LABELS)
    seen = []
    fit = q.fit
    monkeypatch.setattr(q, "fit", lambda sample: seen.append(sample) or fit(sample))
    model = q.train(docs, labels)
    assert {len(n) for y, _, n in seen[0] if not y} == {360}
    short = "\n".join([GOOD_LINE + f" {n}" for n in range(9)])
    assert model.scores([BAD_LINE + "\n" + BAD_LINE])[0] < 0.3 < model.scores([short])[0]


def test_sample_is_bounded_by_whole_documents(spark, monkeypatch):
    rows = [(k, "\n".join(["a line"] * (k % 7 + 1))) for k in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], LABELS)
    seen = []
    monkeypatch.setattr(q, "fit", lambda sample: seen.append(sample))
    q.train(docs, labels, max_lines=100)
    q.train(docs, labels)
    few, every = ([len(n) for _, _, n in sample] for sample in seen)
    assert 90 < sum(few) <= 100 < sum(every) and len(few) < len(every)


def test_documents_of_all_lengths_are_grouped(spark):
    sizes = np.array([1, 8, 9, 64, 65, 400, 2, 16])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    chains = q._by_length(starts)
    assert sorted(np.concatenate([c.docs for c in chains]).tolist()) == list(range(8))
    for c in chains:
        assert c.mask.shape[1] <= 2 * max(sizes[c.docs].min(), 8)
        for d, lines, mask in zip(c.docs, c.lines, c.mask):
            assert lines[mask].tolist() == list(range(starts[d], starts[d + 1]))


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "a text", "c"), (4, "w " * 200000, "d"), (4, "\n" * 5000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], LABELS)
    out = q.quality(docs, none).collect()
    assert len(out) == 5 and {r.score for r in out} == {0.5} and not any(r.held_out for r in out if r.doc_id is None)
    assert q.quality(docs.limit(0), none).collect() == []
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1)], LABELS)
    trained = q.quality(docs, labels).collect()
    assert len(trained) == 5 and all(0 <= r.score <= 1 for r in trained)
    kept = q.keep_good(docs, none)
    assert kept.columns == docs.columns and sorted(r["score"] for r in kept.collect()) == list("abcde")
