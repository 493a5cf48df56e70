"""Licence scans: phrases, and an exact set-similarity join of text blocks with licence templates.

A block is a line of a text, or a paragraph of several lines (what stands between
empty ones), as its set of tokens.  It meets a template when it holds at least
``threshold`` of the template's tokens, and those of a template of up to SHORT
words one after the other; licence names are looked for in lines,
sentences of licence texts in lines and paragraphs, over which they are often
wrapped.  Tokens are ordered by
their frequency over all blocks, rarest first.  A block that meets the
threshold must hold one of the template's first ``size - need + 1`` tokens
(prefix filter), must have ``need`` template tokens (length filter), and its
first common token must leave enough tokens behind it on both sides
(positional filter); what passes is verified on the whole sets.  The join loses
no block and has no caps.  Texts are split into blocks once; the template tokens
of those that hold any are written into the shared folder, and counts and join
read them there.  All of it is DataFrame expressions.

Templates are a fixed parameter: their tokens, a few dozen, are the only thing
that is sent to the driver (with their counts) or broadcast.

Cases: a null text counts as empty: no words, no places, empty labels, score
0; repeated rows are judged alike; a null ``doc_id`` is kept; extra columns are
ignored; an empty table gives an empty result; a text of any length is split as
a whole, in one row's arrays.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: Phrase to label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: (label, template) for lines: names of licences.
TEMPLATES = (
    ("apache", "Apache License"),
    ("mit", "MIT License"),
    ("isc", "ISC License"),
    ("mpl", "Mozilla Public License"),
    ("gpl", "GNU General Public License"),
    ("lgpl", "Lesser General Public License"),
    ("agpl", "Affero General Public License"),
    ("cc-by-nc", "CC BY NC"),
    ("cc-by-nd", "CC BY ND"),
    ("cc-by-sa", "CC BY SA"),
    ("cc0", "CC0 Public Domain Dedication"),
    ("cc-by", "Creative Commons Attribution"),
    ("bsd", "BSD License"),
    ("epl", "Eclipse Public License"),
    ("artistic", "Artistic License"),
    ("proprietary", "proprietary and confidential unauthorized copying is prohibited"),
)
#: (label, template) for lines and paragraphs: sentences of licence texts.
BODIES = (
    ("apache", "you may not use this file except in compliance with the License you may obtain a copy of the License at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the License is distributed on an as is basis"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("cc-by", "you are free to share copy and redistribute the material in any medium or format you must give appropriate credit"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the GNU Lesser General Public License"),
    ("epl", "this program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the Mozilla Public License"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
)
THRESHOLD = 0.8
#: Words of a template that has to stand as it is: of so few any line might hold the tokens.
SHORT = 4
Templates = tuple[tuple[str, str], ...]
#: What stands between paragraphs.
EMPTY_LINE = r"\n[\x20\x09\x0B-\x0D]*\n"
#: What stands between words, before A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PHRASE = "(?i)(?<![^ ])(?:" + "|".join(PHRASES) + ")(?![^ ])"


def tokens_of(template: str) -> list[str]:
    return sorted(set(re.findall("[a-z0-9]+", template.lower())))


def phrase_of(template: str) -> str | None:
    """The words of a short template in order, with a blank around each."""
    words = re.findall("[a-z0-9]+", template.lower())
    return f" {' '.join(words)} " if len(words) <= SHORT else None


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrase_rows(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_base, first_word, last_word, found (base labels)."""
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        F.trim(F.regexp_replace(text_or_empty(), GAP, " ")).alias("words"),
    )
    parts = words.select(
        "doc_id", "text_hash",
        F.when(F.col("words") == "", F.lit(0)).otherwise(_spaces(F.col("words")) + 1).cast("long").alias("n_words"),
        F.when(F.col("words").rlike(_PHRASE), F.split("words", _PHRASE, -1)).alias("parts"),
        F.when(F.col("words").rlike(_PHRASE), F.regexp_extract_all("words", F.lit(_PHRASE), F.lit(0))).alias("hits"),
    )
    label = F.create_map(*(F.lit(x) for item in PHRASES.items() for x in item))
    behind = _spaces(F.element_at("parts", -1)) + _spaces(F.element_at("hits", -1)) + 1
    return parts.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce(F.size("hits").cast("long"), F.lit(0)).alias("n_base"),
        _spaces(F.element_at("parts", 1)).alias("first_word"),
        (F.col("n_words") - behind).alias("last_word"),
        F.coalesce(F.array_distinct(F.transform("hits", lambda h: F.element_at(label, F.lower(h)))), F.array().cast("array<string>")).alias("found"),
    ).withColumn("n_base", F.when(F.col("n_base") > 0, F.col("n_base")).otherwise(F.lit(0)).cast("long"))


def blocks_of(docs: DataFrame, vocabulary: list[str], short: list[str]) -> DataFrame:
    """(doc_id, text_hash, is_line, tokens, said) per line and per paragraph of several lines: its tokens that stand in
    ``vocabulary``, if there are any, and all its words in order if two of its tokens or more stand in ``short``."""
    text = text_or_empty()
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.struct(F.lit(True).alias("is_line"), x.alias("words")))
    wrapped = F.filter(F.split(text, EMPTY_LINE, -1), lambda x: F.contains(x, F.lit("\n")))
    paragraphs = F.transform(wrapped, lambda x: F.struct(F.lit(False).alias("is_line"), x.alias("words")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.explode(F.concat(lines, paragraphs)).alias("b"))
    words = F.split(F.lower(F.regexp_replace("b.words", GAP, " ")), " ")
    tokens = F.array_intersect(F.array(*map(F.lit, vocabulary)), words)
    rows = rows.select("doc_id", "text_hash", "b.is_line", words.alias("words"), tokens.alias("tokens")).where(F.size("tokens") > 0)
    said = F.when(F.size(F.array_intersect("tokens", F.array(*map(F.lit, short)))) > 1, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    return rows.select("doc_id", "text_hash", "is_line", "tokens", said.alias("said"))


def similar_blocks(docs: DataFrame, names: Templates, bodies: Templates, threshold: float) -> DataFrame:
    """(doc_id, text_hash, label, share) for every block that meets a template's threshold."""
    templates = [(label, tokens_of(text), only, phrase_of(text)) for only, some in ((True, names), (False, bodies)) for label, text in some]
    vocabulary = sorted({t for _, tokens, _, _ in templates for t in tokens})
    found = cut(blocks_of(docs, vocabulary, sorted({t for _, tokens, _, phrase in templates if phrase for t in tokens})))
    counted = found.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    often = {r["token"]: r["n"] for r in counted.collect()}  # no more rows than the templates have tokens
    order = sorted(vocabulary, key=lambda t: (often.get(t, 0), t))
    entry, first = [], set()
    for label, tokens, line_only, phrase in templates:
        need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
        ranked = sorted(tokens, key=order.index)
        for k, t in enumerate(ranked[: len(tokens) - need + 1]):
            first.add(t)
            fixed = {"token": F.lit(t), "label": F.lit(label), "line_only": F.lit(line_only), "t_at": F.lit(k), "t_size": F.lit(len(tokens)), "need": F.lit(need), "phrase": F.lit(phrase).cast("string")}
            entry.append(F.struct(*(v.alias(n) for n, v in fixed.items()), F.array(*map(F.lit, ranked)).alias("t_tokens")))
    index = docs.sparkSession.range(1).select(F.explode(F.array(*entry)).alias("e")).select("e.*")
    blocks = found.withColumn("tokens", F.array_intersect(F.array(*map(F.lit, order)), F.col("tokens")))
    at = blocks.select("doc_id", "text_hash", "is_line", "tokens", "said", F.posexplode("tokens").alias("b_at", "token")).where(F.col("token").isin(*sorted(first)))
    b_left, t_left = F.size("tokens") - F.col("b_at") - 1, F.col("t_size") - F.col("t_at") - 1
    most = F.least("b_at", "t_at") + 1 + F.least(b_left, t_left)
    pairs = at.join(F.broadcast(index), "token").where((F.col("is_line") | ~F.col("line_only")) & (F.size("tokens") >= F.col("need")) & (most >= F.col("need")))
    shared = F.size(F.array_intersect("tokens", "t_tokens"))
    in_order = F.col("phrase").isNull() | F.coalesce(F.contains("said", "phrase"), F.lit(False))
    return pairs.where((shared >= F.col("need")) & in_order).select("doc_id", "text_hash", "label", (shared / F.col("t_size")).alias("share"))


def license_scan(docs: DataFrame, names: Templates = TEMPLATES, bodies: Templates = BODIES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest share of a template that one block of the text holds.
    """
    base = phrase_rows(docs)
    blocks = similar_blocks(docs, names, bodies, threshold)
    best = blocks.groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("share").alias("score"))
    best = best.withColumnsRenamed({"doc_id": "b_id", "text_hash": "b_hash"})
    joined = base.join(best, base["doc_id"].eqNullSafe(best["b_id"]) & (base["text_hash"] == best["b_hash"]), "left")
    every = F.array_union("found", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


OP2_SQL = (
    r"""
WITH t(label, line_only, toks, phrase) AS (VALUES """
    + ", ".join(f"('{label}', {names is TEMPLATES}, {tokens_of(text)}, {repr(phrase_of(text)) if phrase_of(text) else 'NULL'})" for names in (TEMPLATES, BODIES) for label, text in names)
    + r"""),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
w AS (
  SELECT r, doc_id, regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
p AS (
  SELECT r, i - 1 AS pos,
         CASE WHEN ws[i] = 'cc' AND ws[i + 1] = 'by' THEN 'cc-by'
              WHEN ws[i] = 'general' AND ws[i + 1] = 'public' AND ws[i + 2] = 'license' THEN 'gpl'
              WHEN ws[i] = 'all' AND ws[i + 1] = 'rights' AND ws[i + 2] = 'reserved' THEN 'reserved' END AS label
  FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
b AS (
  SELECT r, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels
  FROM p WHERE label IS NOT NULL GROUP BY r),
k AS (
  SELECT r, is_line, list_distinct(words) AS toks, ' ' || array_to_string(words, ' ') || ' ' AS said
  FROM (SELECT r, is_line, regexp_extract_all(lower(block), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM (SELECT r, true AS is_line, unnest(string_split(body, chr(10))) AS block FROM d
              UNION ALL SELECT r, false, unnest(regexp_split_to_array(body, '\n[\x20\x09\x0B-\x0D]*\n')) FROM d))),
m AS (
  SELECT r, list(DISTINCT label) AS labels, max(share) AS score
  FROM (SELECT r, label, len(list_intersect(k.toks, t.toks)) / len(t.toks) AS share
        FROM k, t WHERE (is_line OR NOT line_only) AND (phrase IS NULL OR contains(said, phrase)))
  WHERE share >= 0.8 - 1e-9 GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       coalesce(CAST(m.score AS DOUBLE), 0.0) AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""
)
