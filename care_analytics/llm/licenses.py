"""License scans: an exact set-similarity join of license templates with blocks of text.

The text blocks of a template of n words are the windows of 2 n words that start at
every n-th word of a document, so any n words in a row lie whole in one of them.  A
block is a match when it holds at least ``percent`` of the template's different words.

The words of all templates are put in one order by their number in the corpus, the
rarest first.  With o the overlap that a template of s different words needs:

* prefix filter: a match shares one of the template's s - o + 1 rarest words, so only
  blocks around those words are looked at; and that word is among the b - o + 1 rarest
  of the block's b template words;
* length filter: b is at least o;
* positional filter: the shared word with the places i and j in the two ordered lists
  leaves at most 1 + min(s - i - 1, b - j - 1) common words, which must reach o.

Blocks that pass are counted exactly.  A *phrase* is a template whose words must stand
in a row: it needs them all, so its prefix is its rarest word alone, and each place of
that word is checked word by word.

Defined cases: null text is empty, has no words and matches nothing; repeated rows are
scanned each; a null ``doc_id`` stays; an empty table gives no rows; templates and
phrases without words are refused; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_analytics.llm.common import prepare
from care_analytics.llm.terms import NO_ALNUM, as_strings, terms

PERCENT = 80
# Phrases and the labels they stand for.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Sentences by which works state their license, with labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

BLOCK = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("overlap", pa.int32()), ("size", pa.int32())])
PLACE = pa.struct([("label", pa.string()), ("first_word", pa.int64())])
SCAN = "doc_id long, n_words long, places array<struct<label: string, first_word: long>>, blocks array<struct<label: string, first_word: long, overlap: int, size: int>>"


def words_of(text: str) -> list[str]:
    data, bounds, _ = terms(pa.array([text]), NO_ALNUM)
    out = as_strings(data, bounds).to_pylist()
    if not out:
        raise ValueError("a template or phrase has no words")
    return out


def word_numbers(batch: pa.RecordBatch, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number in ``vocabulary`` (or -1) of each word of the batch, and the index of each text's first word."""
    data, bounds, first = terms(batch.column(1), NO_ALNUM)
    return pc.index_in(as_strings(data, bounds), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False), first


def rarest_first(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` (of the templates, so bounded by them) by its numbers in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = pa.array(vocabulary, pa.large_string()), np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            numbers, _ = word_numbers(batch, known)
            total += np.bincount(numbers[numbers >= 0], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary)), pa.int32()), pa.array(total)], ["word", "n"])

    counts = docs.mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {r["word"]: r["n"] for r in counts.collect()}
    return [w for _, w in sorted((n.get(i, 0), w) for i, w in enumerate(vocabulary))]


def phrase_places(number: np.ndarray, first: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of the places where the words of ``phrase`` stand in a row within one document."""
    rare = int(phrase.argmin())  # numbers ascend with the count
    start = np.flatnonzero(number == phrase[rare]) - rare
    start = start[(start >= 0) & (start + len(phrase) <= len(number))]
    for k, word in enumerate(phrase):
        start = start[number[start + k] == word]
    doc = np.searchsorted(first, start, side="right")
    return start[start + len(phrase) <= first[np.minimum(doc, len(first) - 1)]]


def block_matches(number: np.ndarray, first: np.ndarray, template: np.ndarray, length: int, need: int) -> list[tuple[int, int, int]]:
    """(document, first word in it, overlap) of the blocks that hold ``need`` words of ``template``
    (its different words, ascending), a text of ``length`` words."""
    known = np.flatnonzero(number >= 0)
    n_words, prefix = np.diff(first), template[:len(template) - need + 1]
    seed = known[np.isin(number[known], prefix)]
    if not len(seed):
        return []
    doc = np.searchsorted(first, seed, side="right") - 1
    window = (seed - first[doc]) // length
    # numbers of blocks: those of one document after another
    base = np.concatenate([[0], np.cumsum(-(-n_words // length))])
    asked = np.unique(np.concatenate([base[doc] + window, (base[doc] + window - 1)[window > 0]]))
    doc = np.searchsorted(base, asked, side="right") - 1
    start = first[doc] + (asked - base[doc]) * length
    low = np.searchsorted(known, start)
    high = np.searchsorted(known, np.minimum(start + 2 * length, first[doc + 1]))
    # the different template words of each block, rarest first
    block = np.repeat(np.arange(len(asked)), high - low)
    inside = known[np.arange(len(block)) - np.repeat(np.cumsum(high - low) - high, high - low)]
    span = int(number.max()) + 1
    block, word = np.divmod(np.unique(block * span + number[inside]), span)
    size = np.bincount(block, minlength=len(asked))
    j = np.arange(len(block)) - np.repeat(np.cumsum(size) - size, size)
    i = np.searchsorted(template, word)
    own = (i < len(template)) & (template[np.minimum(i, len(template) - 1)] == word)
    b = size[block]
    passing = own & (b >= need) & (i <= len(template) - need) & (j <= b - need) & (1 + np.minimum(len(template) - i - 1, b - j - 1) >= need)
    chosen = np.zeros(len(asked), bool)
    chosen[block[passing]] = True
    overlap = np.bincount(block[own], minlength=len(asked))
    hit = np.flatnonzero(chosen & (overlap >= need))
    return list(zip(doc[hit].tolist(), (start[hit] - first[doc[hit]]).tolist(), overlap[hit].tolist()))


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, the places of all phrases and the matching blocks of all templates, per document."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    split = [(label, words_of(text)) for label, text in templates]
    split_phrases = [(label, words_of(text)) for label, text in phrases]
    vocabulary = rarest_first(docs, sorted({w for _, words in split + split_phrases for w in words}))
    rank = {w: i for i, w in enumerate(vocabulary)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_string())
        for batch in batches:
            number, first = word_numbers(batch, known)
            places: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            blocks: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for label, words in split_phrases:
                start = phrase_places(number, first, np.array([rank[w] for w in words]))
                for doc, at in zip((np.searchsorted(first, start, side="right") - 1).tolist(), start.tolist()):
                    places[doc].append({"label": label, "first_word": at - int(first[doc])})
            for label, words in split:
                different = np.array(sorted({rank[w] for w in words}))
                need = -(-percent * len(different) // 100)
                for doc, at, overlap in block_matches(number, first, different, len(words), need):
                    blocks[doc].append({"label": label, "first_word": at, "overlap": overlap, "size": len(different)})
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(places, pa.list_(PLACE)), pa.array(blocks, pa.list_(BLOCK))],
                                             ["doc_id", "n_words", "places", "blocks"])

    return docs.mapInArrow(scan, SCAN)


def license_digest(docs: DataFrame) -> DataFrame:
    """One row per document: numbers of places and blocks, labels, and as score the largest share of a
    template in a block (1 where a phrase stands)."""

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    starts = F.transform("places", lambda p: p["first_word"])
    base, own = (F.transform(c, lambda p: p["label"]) for c in ("places", "blocks"))
    most = F.array_max(F.transform("blocks", lambda b: b["overlap"].cast("double") / b["size"]))
    return license_scan(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(most, F.lit(0.0))).alias("score"), F.size("blocks").cast("long").alias("n_blocks"))


def license_sql() -> str:
    """The same by joining every word with every template that holds it."""
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    holds = ", ".join(f"({k}, {text(label)}, {text(w)}, {len(words)}, {len(set(words))})"
                      for k, (label, words) in enumerate((label, words_of(t)) for label, t in TEMPLATES) for w in sorted(set(words)))
    lists = ", ".join(f"({text(label)}, [{', '.join(map(text, words_of(t)))}])" for label, t in PHRASES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), phrase(label, words) AS (VALUES {lists}),
template(id, label, word, length, size) AS (VALUES {holds}),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS pos, ws FROM d),
place AS (SELECT r, label, pos FROM w JOIN phrase ON word = words[1] AND ws[pos + 1:pos + len(words)] = words),
seen AS (
  SELECT DISTINCT r, id, label, word, size, k FROM (
    SELECT r, id, label, w.word, size, pos // length AS k FROM w JOIN template USING (word)
    UNION ALL SELECT r, id, label, w.word, size, pos // length - 1 FROM w JOIN template USING (word)
  ) WHERE k >= 0
), block AS (SELECT r, id, label, k, count(*)::DOUBLE / any_value(size) AS share FROM seen GROUP BY r, id, label, k HAVING 100 * count(*) >= {PERCENT} * any_value(size)),
p AS (SELECT r, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM place GROUP BY r),
b AS (SELECT r, count(*) AS n, max(share) AS share, list(DISTINCT label) AS labels FROM block GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(p.n, 0) AS n_base, p.first_word::BIGINT AS first_word, p.last_word::BIGINT AS last_word,
       array_to_string(coalesce(p.labels, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(p.labels, []), coalesce(b.labels, [])))), ',') AS labels,
       CASE WHEN p.n > 0 THEN 1.0 ELSE coalesce(b.share, 0.0) END::DOUBLE AS score, coalesce(b.n, 0) AS n_blocks
FROM d LEFT JOIN p USING (r) LEFT JOIN b USING (r)
"""
