import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulse.llm import toxicity as tx

from tests.conftest import SF

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF['0.1']}/documents.parquet")
    labels = spark.read.parquet(f"{SF['0.1']}/labels.parquet")
    return docs, labels, tx.train(docs, labels)


def brute_cost(model, letters):
    code = [0, 0, *tx._code(letters), 0]
    return sum(model.costs[(a * tx._SYMBOLS + b) * tx._SYMBOLS + c] for a, b, c in zip(code, code[1:], code[2:]))


def test_viterbi_finds_the_cheapest_reading():
    costs = tx._costs(tx.trigram_table(Counter({"idiot": 3, "ill": 2, "lid": 5})), tx.trigram_table(Counter({"idiot": 1})))
    model = tx.Model(costs, {}, 0.1, ())
    for written in ("1d10t", "i1l", "l1d", "0i|"):
        options = [[(c, 0.0)] if c.isalpha() else [(x, tx._LOOK_COST) for x in tx.LOOKS_LIKE[c]] + [
            ("", tx._EDGE_COST if k in (0, len(written) - 1) and not c.isdigit() else tx._SKIP_COST)]
            for k, c in enumerate(written)]
        readings = [("".join(x for x, _ in way), sum(c for _, c in way)) for way in itertools.product(*options)]
        want = min(cost + brute_cost(model, r) for r, cost in readings)
        got = model.viterbi(written)
        assert min(cost + brute_cost(model, r) for r, cost in readings if r == got) == pytest.approx(want)


@pytest.mark.parametrize("written,plain", [
    ("1d10t", "idiot"), ("$tupid", "stupid"), ("l0s3r", "loser"), ("tr@sh", "trash"), ("looooser", "loser"),
    ("stuuupid!!!", "stupid"), ("i.d.i.o.t", "idiot"), ("STUPID,", "stupid"), ("hello", "hello"), ("the***", "the")])
def test_restores_disguised_words(trained, written, plain):
    assert trained[2].restore(written) == plain


def test_spaced_letters_are_joined(trained):
    assert "stupid" in trained[2].words("you are s t u p i d today")
    assert trained[2].words("a a a a a") == ["a"] * 5


@pytest.mark.parametrize("written,plain", [
    ("y o u i d i o t", "idiot"), ("id iot", "idiot"), ("i d iot", "idiot"), ("st upid", "stupid"), ("s tupid", "stupid"), ("stu pid", "stupid"),
    ("id-iot", "idiot"), ("id.iot", "idiot"), ("1d 10t", "idiot"), ("tra sh", "trash"), ("l o ser", "loser"), ("a s s", "ass")])
def test_words_set_apart_are_joined(trained, written, plain):
    text = "the thing is that it and the {} was here for all of them"
    assert plain in trained[2].words(text.format(written)) and plain not in trained[2].words(text.format("house"))


def test_joining_agrees_with_the_whole_path(trained):
    """Decisions by two letters on each side are those of the Viterbi path over all words."""
    model = trained[2]
    for text in ("the id iot was here", "you are st upid and i d iot", "he said th at on ly", "so l o ser"):
        tokens = text.split()
        whole = set(model.viterbi(text).split())
        assert {w for w in model._across(tokens, [model.restore(t) for t in tokens])} == whole - set(tokens)


@pytest.mark.parametrize("written,plain", [
    ("1" * 60 + "d10t", "idiot"), ("i" * 40 + "diot", "idiot"), ("l" + "o" * 5000 + "ser", "loser"), ("$tup" + "1" * 37 + "d", "stupid")])
def test_long_words_are_restored_too(trained, written, plain):
    restored = trained[2].restore(written)
    assert restored in (plain, plain[0] + plain, plain.replace("oo", "o"))


def test_no_cut_through_a_long_row_of_letters(trained):
    text = " ".join("x" * 38 + "stupid")
    assert any("stupid" in w for w in trained[2].words(text))
    assert len(trained[2].words("a b 1 " * 50_000)) > 100_000


def test_batches_score_as_single_texts_do(spark, trained):
    """Scores of batches, from numbered tokens and pairs, are those of the texts one by one."""
    docs, _, model = trained
    rng = random.Random(3)
    texts = [r.text for r in docs.select("text").limit(400).collect()]
    for text in texts[:250]:
        words = text.split()[:40]
        for k in range(len(words)):
            r = rng.random()
            if r < 0.1:
                words[k] = " ".join(words[k])
            elif r < 0.2:
                words[k] = words[k][:2] + " " + words[k][2:]
            elif r < 0.3:
                words[k] = words[k].replace("i", "1").replace("s", "$").replace("e", "3")
            elif r < 0.4:
                words[k] = rng.choice(["idiot", "id iot", "st upid", "1d1ot", "l0ser", "lo ser", "a", "I", "!", "(we", "me!", "x.y.z"])
        texts.append(" ".join(words))
    texts += [None, "", "   ", "a", "a b", "i d iot", "y o u i d i o t", "\u3000s t u p i d\x85x", "a a a", "x " * 5000 + "s t upid"]
    assert model.scores(pa.array(texts, pa.string())) == [model.score(t or "") for t in texts]
    for k in range(0, 400, 7):  # and whatever stands beside them in the batch
        assert model.scores(pa.array([texts[k]], pa.string())) == [model.score(texts[k])]


def test_long_disguised_word_next_to_a_fragment(trained):
    """A disguised token of any length is read together with its neighbours."""
    model = trained[2]
    text = "the thing is that it and the {} was here for all of them"
    for written, plain in (("stu p1d", "stupid"), ("$tup 1d", "stupid"), ("st up1d", "stupid"), ("i d10t", "idiot"), ("lo s3r", "loser"), ("l 0s3r", "loser")):
        assert plain in model.words(text.format(written)), written
        assert model.score(text.format(written)) > 0.7, written


def test_all_evidence_of_the_sample_is_kept(spark):
    """More grams than sixty thousand: none is dropped."""
    words = ["".join(p) + "xyqz"[k % 4] + "mn"[k // 4 % 2] for k, p in enumerate(itertools.product("abcdefgh", repeat=5))
             if not any(a == b for a, b in zip(p, p[1:]))]
    size = 500
    texts = [" ".join(words[at: at + size]) for at in range(0, len(words), size)]
    rows = [(k * 20 + c, t) for k, t in enumerate(texts) for c in range(9)]
    rows += [(10**6 + k, f"plain w{k} text") for k in range(4000)]
    learned = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1 for w in t.split() if i < 10**6)
    model = tx.train(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, int(i < 10**6)) for i, _ in rows], LABELS))
    wanted = {w + "$" for w, n in learned.items() if n >= tx.MIN_DOCS}
    assert len(model.evidence) > 60_000 and len(wanted) > 15_000
    assert wanted <= set(model.evidence)


def test_held_out_accuracy(spark, trained):
    docs, labels, _ = trained
    rows = tx.toxicity(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.005 * len(clean)


def test_disguise_does_not_hide(trained):
    model = trained[2]
    text = "the thing is that it and the {} was here for all of them"
    for plain, written in (("idiot", "1d10t"), ("loser", "l0o0ser"), ("trash", "t r a s h"), ("stupid", "s-t-u-p-i-d")):
        assert model.score(text.format(plain)) > 0.7 > model.score(text.format("house"))
        if written != "l0o0ser":
            assert model.score(text.format(written)) > 0.7


def test_trigrams_cover_all_documents(spark):
    docs = spark.createDataFrame([(1, "ab Ab"), (2, None), (3, "x9y"), (4, "")], DOCS)
    assert np.array_equal(tx.corpus_trigrams(docs), tx.trigram_table(Counter({"ab": 2, "x": 1, "y": 1})))


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "a text", "c"), (4, "w " * 100000, "d"), (4, "1" * 5000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], LABELS)
    out = tx.toxicity(docs, none).collect()
    assert len(out) == 5 and len({r.score for r in out}) == 1
    assert tx.toxicity(docs.limit(0), none).collect() == []
    labels = spark.createDataFrame([(2, 1), (3, 0), (5, 1), (1, 0), (4, 0)], LABELS)
    assert len(tx.toxicity(docs, labels).collect()) == 5
    assert {r.doc_id: r.restored for r in tx.restore(docs.where("doc_id = 2"), tx.train(docs, none)).collect()} == {2: ""}
