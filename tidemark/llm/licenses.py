"""License scans by an exact set-similarity join of text blocks with license templates.

Native: every step is a DataFrame expression (regular expressions, array and
higher-order functions, one aggregation); no Python runs on rows.

* Words: ASCII letters lower-cased, then maximal runs of digits, ``a-z`` and
  non-ASCII characters.
* Base: places where a fixed phrase stands word by word.
* Method: every document is cut into blocks of ``BLOCK`` words starting at
  every ``STEP``-th word (the last block reaches the end), so any passage of up
  to ``BLOCK - STEP + 1`` words lies in one block.  A block matches a template
  when it holds at least ``ceil(CONTAINMENT * |T|)`` of the template's distinct
  words.  Tokens are ordered globally by document frequency (rarest first, ties
  by the word); a template's prefix is its first ``|T| - need + 1`` tokens in
  that order.  Per block and template: a length filter (the block's template
  words number at least ``need``), a prefix filter (the block holds a prefix
  token), a positional filter (one plus the tokens after the first common one,
  in both orders, can still reach ``need``), then the exact overlap.  All blocks
  that meet the threshold are found; the filters only skip blocks that cannot.

The template list is a fixed parameter, so the frequency table that the driver
reads has at most one row per template word.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, STEP = 64, 32
CONTAINMENT = 0.8

# Fixed values of the contract: base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices as published by the licenses themselves, with their labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    """Words of a text column (null: none)."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    # splitting at the gaps between words gives the same words as extracting them, with empty ends removed
    return F.array_remove(F.split(lowered, _GAP), "")


def _places(words: Column, n: Column, phrase: str) -> Column:
    parts = phrase.split()
    k = len(parts)
    def at(i):
        cond = None
        for j, part in enumerate(parts):
            term = words[i + j] == F.lit(part)
            cond = term if cond is None else cond & term
        return cond

    found = F.filter(F.sequence(F.lit(0), n - k), at)
    return F.when(n >= k, found).otherwise(F.array().cast("array<int>"))


def _labels(pairs: list[tuple[Column, str]]) -> Column:
    named = F.array(*[F.when(flag, F.lit(label)) for flag, label in pairs])
    return F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isNotNull())))


def _overlap(ordered: Column, prefix: Column, size: int, need: int):
    """Overlap of a block's template words ``r`` (in global order) with one template, 0 where a filter rules it out."""

    def overlap(r):
        first = F.try_element_at(F.array_intersect(r, prefix), F.lit(1))
        p = F.array_position(ordered, first) - 1
        pb = F.array_position(r, first) - 1
        bound = 1 + F.least(F.lit(size) - p - 1, F.size(r) - pb - 1)
        passes = (F.size(r) >= need) & first.isNotNull() & (bound >= need)
        return F.when(passes, F.size(F.array_intersect(r, ordered))).otherwise(F.lit(0))

    return overlap


def template_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """Template words ordered globally: by the number of documents that hold them, then by the word."""
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    held = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), words_of(F.col("text")))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    freq = {row.word: row["count"] for row in counts.collect()}  # at most one row per template word
    return sorted(vocabulary, key=lambda w: (freq.get(w, 0), w))


def scan(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """Per documents row: word count, base phrase places and labels, template labels and score.

    Null text counts as empty.  ``first_word`` and ``last_word`` are the least
    and greatest start of a base place, null without one.  Label strings are
    distinct, sorted and comma-joined, empty without labels.  ``score`` is the
    greatest share of a template's words found in one block among templates
    that meet ``containment``, 0.0 without one.  Repeated rows give repeated
    results; other columns are ignored.
    """
    order = template_order(docs, templates)
    rank = {w: i for i, w in enumerate(order)}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text").cast("string")).alias("w"))
    w = F.col("w")
    n = F.size(w)
    places = [(_places(w, n, phrase), label) for phrase, label in PHRASES]
    every = F.concat(*[p for p, _ in places])
    last_block = F.when(n <= BLOCK, F.lit(0)).otherwise(F.ceil((n - BLOCK) / STEP)).cast("int")
    vocabulary = F.array(*[F.lit(x) for x in order])
    reduced = F.transform(
        F.sequence(F.lit(0), last_block),
        lambda k: F.array_intersect(vocabulary, F.array_distinct(F.slice(w, k * STEP + 1, BLOCK))),
    )
    best, prefixes = [], set()
    for label, text in templates:
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        size = len(tokens)
        need = math.ceil(containment * size - 1e-9)
        prefixes.update(tokens[: size - need + 1])
        prefix = F.array(*[F.lit(x) for x in tokens[: size - need + 1]])
        ordered = F.array(*[F.lit(x) for x in tokens])

        top = F.coalesce(F.array_max(F.transform(F.col("reduced"), _overlap(ordered, prefix, size, need))), F.lit(0))
        best.append((top, label, size, need))
    # prefix filter over the whole document first: without any prefix token no block can match
    hopeful = F.arrays_overlap(w, F.array(*[F.lit(x) for x in sorted(prefixes)]))
    scored = rows.select(
        "doc_id", "w", F.when(hopeful, reduced).otherwise(F.array().cast("array<array<string>>")).alias("reduced")
    )
    base = _labels([(F.size(p) > 0, label) for p, label in places])
    method = _labels([(top >= need, label) for top, label, _, need in best] + [(F.size(p) > 0, label) for p, label in places])
    shares = [F.when(top >= need, top / F.lit(float(size))).otherwise(F.lit(0.0)) for top, _, size, need in best]
    return scored.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(method, ",").alias("labels"),
        F.greatest(F.lit(0.0), *shares).alias("score"),
    )


def oracle_sql(templates=TEMPLATES, containment: float = CONTAINMENT) -> str:
    """DuckDB SQL for ``scan`` over ``documents`` by brute force: every block against every template."""
    def lit(s):
        return "'" + s.replace("'", "''") + "'"

    def phrase_sql(phrase):
        parts = phrase.split()
        cond = " AND ".join(f"w[i + {j + 1}] = {lit(p)}" for j, p in enumerate(parts))
        return f"CASE WHEN len(w) >= {len(parts)} THEN list_filter(range(0, len(w) - {len(parts) - 1}), lambda i: {cond}) ELSE []::INTEGER[] END"

    rows = ", ".join(
        f"({lit(label)}, {len(set(text.split()))}, {math.ceil(containment * len(set(text.split())) - 1e-9)}, "
        f"[{', '.join(lit(x) for x in sorted(set(text.split())))}])"
        for label, text in templates
    )
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN {lit(label)} END" for i, (_, label) in enumerate(PHRASES))
    places = ", ".join(f"{phrase_sql(phrase)} AS p{i}" for i, (phrase, _) in enumerate(PHRASES))
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT *, {places} FROM d),
t(label, n, need, tokens) AS (VALUES {rows}),
k AS (SELECT rid, unnest(range(0, CASE WHEN len(w) <= {BLOCK} THEN 0 ELSE ceil((len(w) - {BLOCK}) / {STEP})::BIGINT END + 1)) AS k, w FROM d),
m AS (SELECT k.rid, t.label, t.n, t.need, max(len(list_intersect(list_distinct(k.w[{STEP} * k.k + 1 : {STEP} * k.k + {BLOCK}]), t.tokens))) AS best
  FROM k JOIN t ON true GROUP BY ALL),
s AS (SELECT rid, list(label) FILTER (WHERE best >= need) AS found, max(CASE WHEN best >= need THEN best / n ELSE 0.0 END) AS score FROM m GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(p0) + len(p1) + len(p2))::BIGINT AS n_base,
  list_min(p0 || p1 || p2)::BIGINT AS first_word, list_max(p0 || p1 || p2)::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(list_filter([{base}], lambda x: x IS NOT NULL))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_filter(coalesce(found, []) || [{base}], lambda x: x IS NOT NULL))), ',') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM b LEFT JOIN s USING (rid)"""
