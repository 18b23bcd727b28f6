import re

import pytest

from pulse.llm import license_scan as ls

SCHEMA = "doc_id long, text string"
BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in BETWEEN.split(lower) if w]


def base(text):
    """Places of the phrases, by trying every word."""
    w = words(text)
    return sorted((at, label) for phrase, label in ls.PHRASES for p in [phrase.split()]
                  for at in range(len(w)) if w[at: at + len(p)] == p)


def scanned(spark, rows, schema=SCHEMA):
    return ls.scan(spark.createDataFrame(rows, schema)).collect()


def expected(text):
    places = base(text)
    return (len(words(text)), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({name for _, name in places})))


TEXTS = [
    None, "", "   \n\t", "mit", "license", "MIT License", "mit-license, MIT\nLICENSE! the mit licenses", "cc by cc by-sa CC  BY",
    "gnu general public gnu general public license license", "gnu public general license", "apache licensE.", "Mit licenseé mit license",
    "KELVIN Kelvin mit license", "apache gnu general public license", "general public license", "0 mit license 9 cc by4 cc by 4",
    "MIT LICENSE m\u0130t license mit l\u0131cense", "\u212aey gnu general public license wor\u212a mit license", "\u0130\u0130 CC BY \u00c9 \u212a",
]


def test_phrases_against_brute_force(spark):
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in scanned(spark, list(enumerate(TEXTS)))}
    assert got == {k: expected(t) for k, t in enumerate(TEXTS)}


def test_notices_with_words_put_in_and_left_out(spark):
    mit = dict((name, text) for text, name in ls.NOTICES)["mit-text"].split()
    texts = {
        "whole": " ".join(mit),
        "put in": " ".join(["some"] * 50 + mit[:20] + ["(well,", "mostly)"] + mit[20:]),
        "left out": " ".join(mit[:18] + mit[20:]),
        "half": " ".join(mit[: len(mit) // 2 - 3]),
        "shuffled": " ".join(sorted(mit)),
        "scattered": " ".join(w + " x" for w in mit),
    }
    rows = scanned(spark, list(enumerate(texts.values())))
    found = {name: ("mit-text" in r.labels.split(","), r.score) for name, r in zip(texts, sorted(rows, key=lambda r: r.doc_id))}
    assert [name for name, (hit, _) in found.items() if hit] == ["whole", "put in", "left out"]
    assert found["whole"][1] == 1 and 0.6 <= found["left out"][1] < 1 and 0 < found["half"][1] < 0.6
    assert found["scattered"][1] == 0


def test_spans_tell_where(spark):
    df = spark.createDataFrame([(1, "x y released under the mit license z mit license")], SCHEMA)
    got = {(r.label, r.phrase, r.first_word, r.cover) for r in ls.spans(df).collect()}
    assert got == {("mit", True, 5, 1.0), ("mit", True, 8, 1.0), ("mit-release", False, 2, 1.0)}


def test_labels_keep_the_base_ones(spark):
    r, = scanned(spark, [(1, "Licensed under the Apache License, Version 2.0. Released under the MIT license")])
    assert (r.base_labels, r.labels, r.score) == ("apache,mit", "apache,apache-2.0,mit,mit-release", 1.0)


def test_repeated_rows_nulls_and_clashing_names(spark):
    rows = [(1, "mit license", "a", 1, 2, 3)] * 3 + [(1, "cc by", "a", 1, 2, 3), (None, "cc by", None, 0, 0, 0), (None, None, None, 0, 0, 0)]
    got = scanned(spark, rows, SCHEMA + ", label string, template int, h1 int, place int")
    assert sorted((r.doc_id or 0, r.n_words, r.n_base, r.labels) for r in got) == [
        (0, 0, 0, ""), (0, 2, 1, "cc-by"), (1, 2, 1, "cc-by")] + [(1, 2, 1, "mit")] * 3
    assert ls.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_text_and_many_copies(spark):
    long = "mit license word " * 100_000
    rows = [(0, long)] + [(k, "this work is licensed under the GNU General Public License, version 3.") for k in range(1, 500)]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    assert (got[0].n_base, got[0].first_word, got[0].last_word) == (100_000, 0, 299_997)
    assert {(r.n_base, r.labels) for k, r in got.items() if k} == {(1, "gpl,gpl-3.0")}


def test_plan_is_native_with_one_shuffle_of_hits(spark):
    df = ls.scan(spark.createDataFrame([(1, "mit license")], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning(doc_id") == 1


@pytest.mark.parametrize("text", [t for t, _ in ls.NOTICES])
def test_every_notice_finds_itself(spark, text):
    r, = scanned(spark, [(1, "before " + text.upper() + " after")])
    assert dict((t, name) for t, name in ls.NOTICES)[text] in r.labels.split(",") and r.score == 1
