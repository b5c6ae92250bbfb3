"""License scan: phrases, and an exact set-similarity join of text blocks with templates.

A template is a public license notice, taken as the set of its words; a block of a template
of ``m`` words is any ``2 m`` words of a text that start at a multiple of ``m``, so every
passage up to ``m + 1`` words lies in one. A block meets a template if it holds the share
``THRESHOLD`` of the template's words. The join is exact: words are put in the order of
their frequency over all documents, the rarest first, and a block that meets a template has
one of the template's first ``n - need + 1`` words (prefix filter); blocks with fewer words
than needed (length filter), or with too few words from the first common one on (position
filter), are left out before the sets are compared.

Everything is column expressions: one scan keeps the words that occur in templates or
phrases, one aggregate counts them, and the join works inside each row on the inverted
index of the templates' prefixes, whose size is that of the templates, never of the data.
Nothing is shuffled but one count a word and task.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import id_and_text, stored, table

# --- fixed values: separators of words, phrases of the base scan
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# --- fixed values: public license notices
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
# ----------------------------------------------------------
THRESHOLD = 0.9
BLOCKS = 1 << 31                            # more than a text has words


def words_of(text: str) -> list[str]:
    """Words of a template or phrase, as the scan takes them from a text."""
    low = text.translate(str.maketrans(UPPER, LOWER))
    return [w for w in re.split(SEPARATORS, low) if w]


def needed(n: int, threshold: float) -> int:
    """Common words that a template of ``n`` different ones asks for."""
    return max(1, math.ceil(n * threshold - 1e-9))


def kept_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id, words``: the words of each text in their places, those outside the
    vocabulary as null."""
    low = F.translate(F.col("text"), UPPER, LOWER)
    words = F.filter(F.split(low, SEPARATORS), lambda w: w != "")
    return id_and_text(docs).select("doc_id", F.transform(words, lambda w: F.when(w.isin(*vocabulary), w)).alias("words"))


def rarest_first(kept: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by its counts over all documents; one row a word reaches the driver."""
    counts = {r["w"]: r["n"] for r in kept.select(F.explode("words").alias("w")).where("w is not null")
              .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _index(templates, order: list[str], threshold: float) -> tuple[Column, Column, list[str]]:
    """Templates as an array of structs, prefix word -> numbers of templates, prefix words."""
    rank = {w: i for i, w in enumerate(order)}
    rows, prefixes = [], {}
    for t, (label, text) in enumerate(templates):
        words = words_of(text)
        own = sorted(set(words), key=rank.get)
        need = needed(len(own), threshold)
        head = own[:len(own) - need + 1]
        for w in head:
            prefixes.setdefault(w, []).append(t)
        strings = [F.array(*[F.lit(w) for w in x]) for x in (head, own)]
        rows.append(F.struct(F.lit(label).alias("label"), F.lit(len(words)).alias("m"), F.lit(need).alias("need"),
                             strings[0].alias("head"), strings[1].alias("own")))
    entries = [x for w, ts in sorted(prefixes.items()) for x in (F.lit(w), F.array(*[F.lit(t) for t in ts]))]
    return F.array(*rows), F.create_map(*entries), sorted(prefixes)


def _phrase_places(words: Column, starts: Column, phrase: str) -> Column:
    """Places among ``starts`` where the phrase's words stand one after another."""
    def here(i: Column) -> Column:
        hit = F.lit(True)
        for k, w in enumerate(words_of(phrase)):
            hit = hit & F.coalesce(F.get(words, i + k) == w, F.lit(False))
        return hit
    return F.filter(starts, here)


def _labelled(label: str):
    return lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("at"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, places, matches`` for every row: ``places`` are ``label, at`` of
    the phrases, ``matches`` are ``label, first, last, containment`` of all blocks that meet
    a template, in words counted from 0.

    A null text is an empty one, and an empty text has no words and no matches; texts may be
    of any length; repeated rows and ids are rows of their own, an empty table gives an empty result.
    Columns other than the id and the text are not read. A text that holds a larger notice
    holds a smaller one within it as well, so it may have the labels of both."""
    vocabulary = sorted({w for text in [p for p, _ in phrases] + [t for _, t in templates] for w in words_of(text)})
    kept = stored(kept_words(docs, vocabulary), "license-words")
    order = rarest_first(kept, vocabulary)
    known, prefixes, heads = _index(templates, order, threshold)
    starts = sorted({words_of(p)[0] for p, _ in phrases})
    words = F.col("words")

    def at(chosen: list[str]) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(w.isin(*chosen), i)), lambda i: i.isNotNull())

    marked = kept.withColumn("marks", at(sorted({*starts, *heads})))
    places = F.concat(*[F.transform(_phrase_places(words, F.col("marks"), p), _labelled(label)) for p, label in phrases])

    def template(t: Column) -> Column:
        return F.element_at(known, t + 1)

    def blocks(i: Column) -> Column:
        """Blocks of all templates with the word at ``i`` in their prefix that hold ``i``."""
        ts = F.coalesce(F.try_element_at(prefixes, F.get(words, i)), F.array().cast("array<int>"))
        return F.flatten(F.transform(ts, lambda t: F.transform(
            F.sequence(F.greatest(F.floor(i / template(t)["m"]) - 1, F.lit(0)), F.floor(i / template(t)["m"])),
            lambda b: t.cast("long") * BLOCKS + b)))

    # one number a candidate: numbers, unlike structs, are told apart by hash
    distinct = F.array_distinct(F.flatten(F.transform(F.col("marks"), blocks)))
    candidates = F.transform(distinct, lambda x: F.struct(F.floor(x / BLOCKS).cast("int").alias("t"), (x % BLOCKS).cast("int").alias("b")))
    cut = F.transform(F.col("found"), lambda c: F.struct(
        c["t"].alias("t"), c["b"].alias("b"), F.array_distinct(F.filter(
            F.slice(words, c["b"] * template(c["t"])["m"] + 1, template(c["t"])["m"] * 2), lambda w: w.isNotNull())).alias("own")))
    long_enough = F.filter(F.col("found"), lambda c: F.size(c["own"]) >= template(c["t"])["need"])
    ranks = F.array(*[F.lit(w) for w in order])

    def reachable(c: Column) -> Column:
        first = F.array_position(ranks, F.get(F.array_intersect(template(c["t"])["head"], c["own"]), 0))
        return F.size(F.filter(c["own"], lambda w: F.array_position(ranks, w) >= first)) >= template(c["t"])["need"]

    compared = F.transform(F.filter(F.col("found"), reachable), lambda c: F.struct(
        c["t"].alias("t"), c["b"].alias("b"), F.size(F.array_intersect(template(c["t"])["own"], c["own"])).alias("common")))
    met = F.filter(F.col("found"), lambda c: c["common"] >= template(c["t"])["need"])
    matches = F.transform(met, lambda c: F.struct(
        template(c["t"])["label"].alias("label"), (c["b"] * template(c["t"])["m"]).cast("long").alias("first"),
        F.least((c["b"] + 2) * template(c["t"])["m"] - 1, F.size(words) - 1).cast("long").alias("last"),
        (c["common"] / F.size(template(c["t"])["own"])).alias("containment")))
    out = marked.withColumn("places", places).withColumn("found", candidates)
    for stage in (cut, long_enough, compared):
        out = out.withColumn("found", stage)
    return out.select("doc_id", F.size("words").cast("long").alias("n_words"), "places", matches.alias("matches"))


def op13(spark, sf_dir: str) -> DataFrame:
    """Phrases and labels of all documents; a phrase counts as a whole template."""
    at = F.col("places.at")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        _joined(F.col("places.label")).alias("base_labels"), _joined(F.concat("places.label", "matches.label")).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"))


def _sql_words(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_PLACES = " UNION ALL ".join(
    f"SELECT row, '{label}' AS label, i - 1 AS spot FROM (SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM doc) d "
    f"WHERE words[i:i + {len(words_of(p)) - 1}] = {_sql_words(words_of(p))}" for p, label in PHRASES)
_TEMPLATES = ", ".join(f"({t}, '{label}', {len(words_of(x))}, {needed(len(set(words_of(x))), THRESHOLD)}, {_sql_words(sorted(set(words_of(x))))})"
                       for t, (label, x) in enumerate(TEMPLATES))
#: Every block of every template is compared, without a filter.
ORACLE = f"""WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
word AS (SELECT row, unnest(words) AS w, unnest(range(0, len(words))) AS pos FROM doc),
place AS ({_PLACES}),
template(t, label, m, need, own) AS (VALUES {_TEMPLATES}),
token AS (SELECT t, label, m, need, len(own) AS n, unnest(own) AS w FROM template),
block AS (
  SELECT row, t, label, b, count(DISTINCT w) AS common, any_value(need) AS need, any_value(n) AS n
  FROM (SELECT row, word.w, t, label, need, n, unnest([pos // m, pos // m - 1]) AS b FROM word JOIN token ON word.w = token.w) x
  WHERE b >= 0 GROUP BY row, t, label, b),
hit AS (SELECT row, label, common / n AS containment FROM block WHERE common >= need),
base AS (SELECT row, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word FROM place GROUP BY row),
base_label AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY row),
all_label AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
              FROM (SELECT row, label FROM place UNION ALL SELECT row, label FROM hit) x GROUP BY row),
best AS (SELECT row, max(containment) AS score FROM hit GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(b.labels, '') AS base_labels,
  coalesce(a.labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM doc LEFT JOIN base USING (row) LEFT JOIN base_label b USING (row) LEFT JOIN all_label a USING (row) LEFT JOIN best USING (row)"""
