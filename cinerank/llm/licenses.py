"""Licence scan: an exact set-similarity join of text blocks with licence templates.

A text is cut into overlapping blocks of ``block_words`` words, one every half block, so any
passage of up to half a block lies whole in some block; blocks grow with the longest template.  A block matches a template when it
holds at least ``threshold`` of the template's distinct words (containment).  The join is
exact: words are ordered by their global frequency (number of blocks that hold them, counted
over all documents in a first pass), rarest first, and

* prefix filter: with overlap a = ceil(threshold * |T|), a matching block holds one of the
  first |T| - a + 1 words of T; only blocks with such a word are looked at;
* length filter: the block holds at least a distinct template words;
* positional filter: a prefix word at place i of T and j of the block leaves room for at most
  min(|T| - i, |B| - j) common words, which must reach a.

Template words bound everything that is shared with the tasks or counted on the driver; no
document is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.text import as_bytes, hash_words, phrase

#: Phrases of the base rule and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Common public licence notices (label, text).  One-line MIT notices are left to the
#: phrases: their words ("mit" is a German word) are too common for a set test.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                 "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
BLOCK_WORDS = 128
THRESHOLD = 0.9
SHARD_BYTES = 8 << 20
SCHEMA = ("doc_id long, n_words long, base_starts array<long>, base_labels array<string>, "
          "match_labels array<string>, match_starts array<long>, match_scores array<double>")


def _template_sets(templates) -> list[tuple[str, np.ndarray]]:
    return [(label, np.unique(phrase(text))) for label, text in templates]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes | None]]]:
    """Ids and texts in groups of bounded size (one long text may pass it)."""
    ids: list = []
    texts: list[bytes | None] = []
    size = 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
            if texts and size + len(t or b"") > SHARD_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t or b"")
    if texts:
        yield ids, texts


def _occurrences(h: np.ndarray, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, vocabulary index) of all words that are in ``vocab`` (sorted)."""
    gate = np.zeros(1 << 16, dtype=bool)
    gate[(vocab & np.uint64(0xFFFF)).astype(np.int64)] = True
    place = np.flatnonzero(gate[(h & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.searchsorted(vocab, h[place])
    at[at == len(vocab)] = 0
    same = vocab[at] == h[place]
    return place[same], at[same]


def _blocks_of(place: np.ndarray, first: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, block, index into place): the two blocks that hold each word (one for a text's first words)."""
    doc = np.searchsorted(first, place, "right") - 1
    half = (place - first[doc]) // stride
    prior = np.flatnonzero(half > 0)
    return (np.concatenate([doc, doc[prior]]), np.concatenate([half, half[prior] - 1]),
            np.concatenate([np.arange(len(place)), prior]))


def _count(vocab: np.ndarray, stride: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocab), dtype=np.int64)
        for _, texts in _shards(batches):
            h, counts = hash_words(texts, "alnum")
            first = np.concatenate([[0], np.cumsum(counts)])
            place, word = _occurrences(h, vocab)
            doc, block, of = _blocks_of(place, first, stride)
            base = first // stride + np.arange(len(first))  # a number for each block of each text
            key = np.unique((base[doc] + block) * len(vocab) + word[of])
            total += np.bincount(key % len(vocab), minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocab))), pa.array(total)], names=["word", "blocks"])

    return run


def _scan(vocab: np.ndarray, rank: np.ndarray, sets: list[tuple[str, np.ndarray]], phrases, threshold: float,
          stride: int):
    """rank: place of each vocabulary word in the global order (0 rarest)."""
    ordered = [np.sort(rank[np.searchsorted(vocab, t)]) for _, t in sets]
    need = [max(1, math.ceil(threshold * len(t) - 1e-9)) for t in ordered]
    index: dict[int, list[tuple[int, int]]] = {}
    for k, t in enumerate(ordered):
        for i in range(len(t) - need[k] + 1):
            index.setdefault(int(t[i]), []).append((k, i))
    prefix = np.zeros(len(vocab), dtype=bool)
    prefix[list(index)] = True
    whole = [set(t.tolist()) for t in ordered]

    def match(block: list[int]) -> list[tuple[int, float]]:
        """Templates contained in a block, given its distinct words in the global order."""
        seen: dict[int, bool] = {}
        for j, w in enumerate(block):
            for k, i in index.get(w, ()):
                if k not in seen and len(block) >= need[k]:
                    seen[k] = min(len(ordered[k]) - i, len(block) - j) >= need[k]
        out = []
        for k, possible in seen.items():
            if possible and (common := sum(w in whole[k] for w in block)) >= need[k]:
                out.append((k, common / len(whole[k])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _shards(batches):
            h, counts = hash_words(texts, "alnum")
            first = np.concatenate([[0], np.cumsum(counts)])
            n = len(ids)
            base: list[list[tuple[int, str]]] = [[] for _ in range(n)]
            for words, label in phrases:
                at = np.flatnonzero(h[:max(0, len(h) - len(words) + 1)] == words[0])
                for k in range(1, len(words)):
                    at = at[h[at + k] == words[k]]
                doc = np.searchsorted(first, at, "right") - 1
                inside = at + len(words) <= first[doc + 1]
                for d, p in zip(doc[inside].tolist(), (at - first[doc])[inside].tolist()):
                    base[d].append((p, label))
            found: list[list[tuple[str, int, float]]] = [[] for _ in range(n)]
            place, word = _occurrences(h, vocab)
            ranks = rank[word]
            doc, block, _ = _blocks_of(place[prefix[ranks]], first, stride)
            for d, b in np.unique(np.stack([doc, block], 1), axis=0).tolist() if len(doc) else []:
                lo = int(first[d]) + b * stride
                a, e = np.searchsorted(place, [lo, min(lo + 2 * stride, int(first[d + 1]))])
                for k, share in match(np.unique(ranks[a:e]).tolist()):
                    found[d].append((sets[k][0], b * stride, share))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(counts, pa.int64()),
                pa.array([[p for p, _ in sorted(x)] for x in base], pa.list_(pa.int64())),
                pa.array([[v for _, v in sorted(x)] for x in base], pa.list_(pa.string())),
                pa.array([[x[0] for x in f] for f in found], pa.list_(pa.string())),
                pa.array([[x[1] for x in f] for f in found], pa.list_(pa.int64())),
                pa.array([[x[2] for x in f] for f in found], pa.list_(pa.float64())),
            ], names=["doc_id", "n_words", "base_starts", "base_labels", "match_labels", "match_starts", "match_scores"])

    return run


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
                  phrases=PHRASES, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: its words, phrase places and every (block, template) match.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  ``base_starts`` and
    ``base_labels`` list the places where a phrase's words stand consecutively;
    ``match_labels``, ``match_starts`` (first word of the block) and ``match_scores`` (containment)
    list every block with at least ``threshold`` of a template.  Null or wordless texts give empty
    lists; repeated rows give one row each; a null id stays null; other columns are not read; an
    empty table gives no rows.  Two templates with one label may both match a block.  Blocks have
    ``block_words`` words, or twice the words of the longest template if that is more, so that each
    template's passage lies whole in some block.
    """
    stride = max(1, block_words // 2, *(len(phrase(text)) for _, text in templates))
    sets = _template_sets(templates)
    vocab = np.unique(np.concatenate([t for _, t in sets])) if sets else np.zeros(0, np.uint64)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    rank = np.zeros(len(vocab), dtype=np.int64)
    if len(vocab):
        counted = rows.mapInArrow(_count(vocab, stride), "word long, blocks long") \
            .groupBy("word").agg(F.sum("blocks").alias("blocks")).collect()  # one row per template word
        blocks = np.zeros(len(vocab), dtype=np.int64)
        for r in counted:
            blocks[r.word] = r.blocks
        rank[np.lexsort((vocab, blocks))] = np.arange(len(vocab))
    own = [(phrase(text), label) for text, label in phrases]
    return rows.mapInArrow(_scan(vocab, rank, sets, own, threshold, stride), SCHEMA)
