"""License notices in texts, found by diagonal voting.

Every rolling word pair of every text is joined by its hash to the positions at which the
templates hold it. A hit votes for a diagonal: its place in the text less its place in the
template, which is where the template would begin. The votes of a diagonal are the template
places it explains. Phrases count where one diagonal explains the whole phrase. Longer notices may
have words put in or left out, which moves the rest to a diagonal nearby, so diagonals with a fair
share of the votes are merged with their neighbours, and a merged run is a span when it
covers enough of its template. Hits are compared word by word besides their hash, so every vote of a
span is verified.

The templates are constants, so their table is broadcast. Only hits are shuffled, once,
by document; each text also sends one row of its own, so that texts without a hit
are kept without reading the table twice. Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What stands between words: ASCII but for digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The Kelvin sign, and a letter that stands for it.
KELVIN, NO_KELVIN = "\u212a", "\u0138"

# Phrases whose places are counted, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wordings of public licenses and notices, as words, and their labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0", "apache-2.0-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to "
     "this work", "cc0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your "
     "option any later version", "gpl-notice"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("released under the mit license", "mit-release"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation "
     "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     "mit-text"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

# Words of which two in a row say nothing about a license.
COMMON = ("a", "all", "and", "any", "are", "as", "at", "for", "in", "is", "it", "of", "on", "or", "that", "the",
          "this", "to", "under", "with", "you")

#: Least share of a notice's word pairs on one diagonal for the diagonal to count, and on a merged run for a span.
STRONG, COVER = 0.25, 0.6
#: Diagonals at most this far apart are neighbours.
SLACK = 4

_DOC = ("doc_id", "h1", "h2")


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null.

    ``lower`` also changes other letters, which moves no border between words, and no template holds those. The one letter
    beyond ASCII that it would turn into one of ASCII, the Kelvin sign, is another one first.
    """
    kept = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit(KELVIN), F.lit(NO_KELVIN))
    return F.array_remove(F.split(F.lower(kept), BETWEEN), "")


def _pairs(of: Column) -> Column:
    """Each word with the next one; the last word's pair is null."""
    return F.zip_with(of, F.slice(of, F.lit(2), F.size(of)), lambda a, b: F.concat(a, F.lit(" "), b))


def template_pairs(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``(template, label, phrase, n_pairs, at, pair)``: the word pairs of all templates that vote."""
    rows = [(text, label, True) for text, label in phrases] + [(text, label, False) for text, label in notices]
    listed = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(phrase).alias("phrase"),
                                F.lit(text).alias("text")) for k, (text, label, phrase) in enumerate(rows)])
    pairs = (spark.range(1).select(F.inline(listed))
             .select("template", "label", "phrase", F.posexplode(_pairs(words(F.col("text")))).alias("at", "pair")))
    both = F.split("pair", " ")
    says = ~(both[0].isin(*COMMON) & both[1].isin(*COMMON))
    return (pairs.where(F.col("pair").isNotNull() & (F.col("phrase") | says))
            .withColumn("n_pairs", F.count(F.lit(1)).over(Window.partitionBy("template")).cast("int")))


def _hits(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Votes ``(doc_id, h1, h2, n_words, template, label, phrase, n_pairs, at, diagonal)``; every row of
    ``docs`` also gives one with a null template. ``h1`` and ``h2`` hash the text: equal rows share a key."""
    text = F.col("text").cast("string")
    keyed = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"),
                         F.xxhash64(text, F.lit(1)).alias("h2"), words(text).alias("w"))
             .select(*_DOC, F.size("w").cast("long").alias("n_words"), _pairs(F.col("w")).alias("pairs")))
    # The empty pair in front stands for the row itself.
    spread = keyed.select(*_DOC, "n_words", F.posexplode(F.concat(F.array(F.lit("")), F.col("pairs"))).alias("place", "pair"))
    itself = templates.sparkSession.range(1).select(
        F.lit(None).cast("int").alias("template"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("phrase"),
        F.lit(0).alias("n_pairs"), F.lit(0).alias("at"), F.lit("").alias("t_pair"))
    known = templates.withColumnRenamed("pair", "t_pair").unionByName(itself).withColumn("h", F.xxhash64("t_pair"))
    # Constants of this module, or the caller's templates: a few hundred rows.
    return (spread.join(F.broadcast(known), (F.xxhash64("pair") == F.col("h")) & (F.col("pair") == F.col("t_pair")))
            .select(*_DOC, "n_words", "template", "label", "phrase", "n_pairs", "at",
                    (F.col("place") - 1 - F.col("at")).cast("long").alias("diagonal"))
            .repartition(*_DOC))  # what follows needs no other exchange


def _runs(hits: DataFrame, strong: float, slack: int) -> DataFrame:
    """Merged diagonals ``(doc_id, h1, h2, template, label, phrase, first_word, cover)``; a phrase's run is one
    diagonal that explains all of it. Rows with a null template carry ``n_words`` and ``times``."""
    votes = hits.groupBy(*_DOC, "template", "label", "phrase", "n_pairs", "diagonal").agg(
        F.collect_set("at").alias("ats"), F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("times"))
    share = F.size("ats") / F.col("n_pairs")
    kept = votes.where(F.col("template").isNull() | F.when(F.col("phrase"), share == 1).otherwise(share >= strong))
    line = Window.partitionBy(*_DOC, "template").orderBy("diagonal")
    opens = F.col("phrase") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > slack, F.lit(True))
    return (kept.withColumn("run", F.sum(opens.cast("int")).over(
        line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*_DOC, "template", "label", "phrase", "n_pairs", "run")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("covered"),
             F.min(F.col("diagonal") + F.array_min("ats")).alias("first_word"),
             F.max("n_words").alias("n_words"), F.max("times").alias("times"))
        .withColumn("cover", F.when(F.col("template").isNotNull(), F.col("covered") / F.col("n_pairs"))))


def spans(docs: DataFrame, phrases=PHRASES, notices=NOTICES, cover: float = COVER, strong: float = STRONG,
          slack: int = SLACK) -> DataFrame:
    """``(doc_id, label, phrase, first_word, cover)``: every place of a phrase and every verified span of a
    notice, one row each; equal rows of ``docs`` give their spans once."""
    runs = _runs(_hits(docs, template_pairs(docs.sparkSession, phrases, notices)), strong, slack)
    return runs.where(F.col("cover") >= cover).select("doc_id", "label", "phrase", "first_word", "cover")


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, cover: float = COVER, strong: float = STRONG,
         slack: int = SLACK) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_words``, ``n_base`` (places of the
    phrases), ``first_word`` and ``last_word`` (their smallest and largest start; null without any),
    ``base_labels``, ``labels`` (with those of verified notices), ``score`` (the best share of a
    template that a run covers; 1 with a phrase, 0 without a run).

    Null and empty texts have no words, no labels ('') and score 0. Repeated rows keep their rows,
    null ids theirs. An empty table gives no row. A text is one row and its hits one group, so
    a very long one needs memory in proportion to itself only.
    """
    runs = _runs(_hits(docs, template_pairs(docs.sparkSession, phrases, notices)), strong, slack)
    base = F.col("phrase") & F.col("template").isNotNull()
    found = F.when(F.col("cover") >= cover, F.col("label"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_doc = runs.groupBy(*_DOC).agg(
        F.max("n_words").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"), names(found).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template").isNull(), F.col("times"))).alias("times"))
    return (per_doc.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))


def _values(rows) -> str:
    return ", ".join(f"({k}, '{label}', {phrase}, '{text}')" for k, (text, label, phrase) in enumerate(rows))


#: The same in plain SQL: pairs by text, runs by the gaps between diagonals.
ORACLE_SQL = f"""
    WITH t(template, label, phrase, text) AS (VALUES {_values(
        [(t, name, True) for t, name in PHRASES] + [(t, name, False) for t, name in NOTICES])}),
    tw AS (SELECT template, label, phrase, string_split(text, ' ') AS w FROM t),
    tp AS (SELECT *, w[i] AS a, w[i + 1] AS b, i - 1 AS spot
           FROM (SELECT *, unnest(range(1, len(w))) AS i FROM tw)),
    tv AS (SELECT template, label, phrase, a, b, spot, count(*) OVER (PARTITION BY template) AS n_pairs FROM tp
           WHERE phrase OR NOT (a IN {COMMON} AND b IN {COMMON})),
    d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_extract_all(
              translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
    dp AS (SELECT rid, w[i] AS a, w[i + 1] AS b, i - 1 AS place
           FROM (SELECT rid, w, unnest(range(1, len(w))) AS i FROM d)),
    votes AS (SELECT rid, template, label, phrase, n_pairs, place - spot AS diagonal, list(DISTINCT spot) AS ats
              FROM dp JOIN tv USING (a, b) GROUP BY ALL),
    kept AS (SELECT * FROM votes WHERE CASE WHEN phrase THEN len(ats) = n_pairs ELSE len(ats) / n_pairs >= {STRONG} END),
    marked AS (SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER line > {SLACK}, true) THEN 1 ELSE 0 END
               AS opens FROM kept WINDOW line AS (PARTITION BY rid, template ORDER BY diagonal)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM marked),
    runs AS (SELECT rid, template, label, phrase, len(list_distinct(flatten(list(ats)))) / any_value(n_pairs) AS cover,
                    min(diagonal + list_min(ats)) AS first_word
             FROM numbered GROUP BY rid, template, label, phrase, run)
    SELECT any_value(d.doc_id) AS doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words,
           count(*) FILTER (phrase) AS n_base,
           min(first_word) FILTER (phrase) AS first_word, max(first_word) FILTER (phrase) AS last_word,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (cover >= {COVER}), '') AS labels,
           coalesce(max(cover), 0.0) AS score
    FROM d LEFT JOIN runs USING (rid) GROUP BY d.rid
"""
