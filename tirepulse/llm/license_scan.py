"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of ``block_words`` words of the document, over its lines
(windows overlap by half, so a notice of up to half a window's words lies whole
in one, however it is wrapped), or a line, or such a window of a longer line. A
block matches a template if at least ``threshold`` of the template's distinct
words occur in it (containment).

1. One pass counts the templates' words over the whole corpus, pre-aggregated
   per task. Rare words come first in the global order.
2. Prefix filter: a template of m words of which a must occur shares one of its
   m - a + 1 rarest words with any matching block, so only blocks with such a
   word are looked at. Length filter: a block needs a words that any template
   has. Positional filter: what is left of either sorted list behind the first
   common word must still reach a.
3. The blocks that remain are verified by their overlap. No block that meets the
   threshold is lost.
4. A template's label is given only if the block also has the template's marks:
   the words (or runs of words) that tell its license from others with nearly
   the same notice. ``LicenseParams`` without marks is the plain join.

The templates are a short list that the caller gives; it is sent to all tasks.
Fixed phrases (consecutive words) are found beside it in the same pass.

Edge cases: null and empty texts have no words and no matches; a template
without words is ignored; repeated rows are scanned one by one; a null doc_id
stays null; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import zip_longest
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tirepulse.llm import textscan as ts
from tirepulse.llm.ship import shipped

# Phrases of license lines and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Sentences of common license notices and their labels.
TEMPLATES = [
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("You may not use this file except in compliance with the License", "apache-2"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("You can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl-2"),
]

# What tells the license of each template from others, in the order
# of TEMPLATES. A block must have every mark; "|" parts alternatives.
MARKS = [
    ("mit",),
    ("person obtaining a copy",),
    ("apache", "version 2|license 2|apache 2|v 2|v2"),
    (),
    ("gnu general public license", "version 3|license 3|v 3|v3"),
    ("gnu general public license",),
    ("lesser|library",),
    ("nc|noncommercial",),
    ("attribution 4|attribution 3|attribution 2|attribution 1|attribution cc|attribution license|attribution international",),
    (),
    ("mozilla",),
]


@dataclass(frozen=True)
class LicenseParams:
    threshold: float = 0.8
    block_words: int = 64
    phrases: tuple = tuple(PHRASES)
    templates: tuple = tuple(TEMPLATES)
    marks: tuple = ()                        # of the templates, in their order; missing ones ask for nothing


#: The license scan proper: the templates with their marks.
NOTICES = LicenseParams(marks=tuple(MARKS))


def split_words(text: str) -> list[str]:
    """Lower-cased (A-Z) words of a short text."""
    data = ts.LOWER[np.frombuffer(text.encode(), np.uint8)]
    start, end = ts.runs(ts.WORD_BYTES[data], np.array([0, data.size]))
    raw = data.tobytes()
    return [raw[s:e].decode() for s, e in zip(start, end)]


class _Templates:
    """Templates in the global order of their words' corpus counts."""

    def __init__(self, params: LicenseParams, counts: dict[str, int]):
        texts = [(sorted(set(split_words(t))), label, marks)
                 for (t, label), marks in zip_longest(params.templates, params.marks[:len(params.templates)], fillvalue=())]
        texts = [(words, label, marks) for words, label, marks in texts if words]
        vocabulary = sorted({w for words, _, _ in texts for w in words}, key=lambda w: (counts.get(w, 0), w))
        order = {w: k for k, w in enumerate(vocabulary)}
        self.labels = [label for _, label, _ in texts]
        self.words = [sorted(order[w] for w in words) for words, _, _ in texts]
        self.marks = [[[np.array([ts.hash_of(w) for w in split_words(run)], np.uint64) for run in mark.split("|")]
                       for mark in marks] for _, _, marks in texts]
        self.needed = [ceil(params.threshold * len(w) - 1e-9) for w in self.words]
        self.by_prefix: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for i, w in enumerate(words[:len(words) - self.needed[t] + 1]):
                self.by_prefix.setdefault(w, []).append((t, i))
        self.hashes = np.array([ts.hash_of(w) for w in vocabulary], np.uint64)
        self.sorted = np.argsort(self.hashes)
        self.in_prefix = np.zeros(len(vocabulary) + 1, bool)       # the last one: not in any template
        self.in_prefix[list(self.by_prefix)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the global order; the size of the vocabulary for other words."""
        if not self.hashes.size:
            return np.zeros(hashes.size, np.int64)
        known = self.hashes[self.sorted]
        at = np.minimum(np.searchsorted(known, hashes), known.size - 1)
        return np.where(known[at] == hashes, self.sorted[at], self.hashes.size)

    def matches(self, block: list[int]):
        """(template, containment) of every template that the block's sorted distinct words meet."""
        have, seen = set(block), set()
        for j, w in enumerate(block):
            for t, i in self.by_prefix.get(w, ()):
                if t in seen:
                    continue
                seen.add(t)                          # w is the first common word of both lists
                words, needed = self.words[t], self.needed[t]
                if min(len(words) - i, len(block) - j) < needed:
                    continue
                overlap = sum(x in have for x in words)
                if overlap >= needed:
                    yield t, overlap / len(words)

    def marked(self, t: int, hashes: np.ndarray) -> bool:
        """Whether a block, given by the hashes of its words, has every mark of a template."""
        whole = np.array([0, hashes.size])
        return all(any(_phrase_places(hashes, whole, run).size for run in mark) for mark in self.marks[t])


def _phrase_places(hashes: np.ndarray, first: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Positions at which the phrase's words stand consecutively inside a document."""
    m = hashes.size - phrase.size + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(hashes[:m] == phrase[0])
    for k in range(1, phrase.size):
        at = at[hashes[at + k] == phrase[k]]
    return at[ts.owners(first, at) == ts.owners(first, at + phrase.size - 1)]


def _word_counts(params: LicenseParams):
    vocabulary = sorted({w for t, _ in params.templates for w in split_words(t)})
    hashes = np.array([ts.hash_of(w) for w in vocabulary], np.uint64)
    order = np.argsort(hashes)

    def run(batches):
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            for _, _, data, cut in ts.slices(batch.column(0)):
                low = ts.LOWER[data]
                found = ts.word_hashes(low, *ts.runs(ts.WORD_BYTES[low], cut))
                at = np.minimum(np.searchsorted(hashes[order], found), len(vocabulary) - 1)
                total += np.bincount(np.where(hashes[order][at] == found, order[at], len(vocabulary)), minlength=total.size)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary, pa.string()), pa.array(total[:-1])], ["word", "n"])

    return run, bool(vocabulary)


def word_counts(docs: DataFrame, params: LicenseParams) -> dict[str, int]:
    """Corpus counts of the templates' words (as many rows as they have words)."""
    run, some = _word_counts(params)
    if not some:
        return {}
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_FOUND = "array<struct<label:string,start:bigint,size:bigint,containment:double>>"


def scan(docs: DataFrame, params: LicenseParams = NOTICES) -> DataFrame:
    """doc_id, n_words, phrases (label, start, size) and blocks (label, start, size,
    containment) of every row; starts and sizes count words."""
    shipped(docs.sparkSession)
    templates = _Templates(params, word_counts(docs, params))
    phrases = [(np.array([ts.hash_of(w) for w in split_words(p)], np.uint64), label) for p, label in params.phrases]
    half = params.block_words // 2

    def blocks_of(numbers, parts):
        """(first word, size) of each block that has a prefix word; ``parts`` are the
        first words of the documents and those of the lines."""
        hit = np.flatnonzero(templates.in_prefix[numbers])
        found = []
        for part_first in parts:
            own = ts.owners(part_first, hit)
            size = part_first[own + 1] - part_first[own]
            step = (hit - part_first[own]) // half
            for k in (0, 1):
                start = part_first[own] + np.where(size <= params.block_words, 0, np.maximum(step - k, 0)) * half
                found.append(np.stack([start, np.minimum(params.block_words, part_first[own + 1] - start)]))
        return np.unique(np.concatenate(found, axis=1), axis=1).T.tolist()

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(2 * batch.num_rows)]       # phrases and blocks of each row
            n_words = np.zeros(batch.num_rows, np.int64)
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                low = ts.LOWER[data]
                start, end = ts.runs(ts.WORD_BYTES[low], cut)
                first = np.searchsorted(start, cut)
                n_words[lo:hi] = np.diff(first)
                hashes = ts.word_hashes(low, start, end)
                for phrase, label in phrases:
                    for at in _phrase_places(hashes, first, phrase).tolist():
                        d = int(ts.owners(first, at))
                        out[2 * (lo + d)].append({"label": label, "start": at - int(first[d]), "size": phrase.size, "containment": 1.0})
                numbers = templates.numbers(hashes)
                edges = np.unique(np.concatenate([cut, np.flatnonzero(data == 0x0A) + 1]))      # starts of lines
                for at, size in blocks_of(numbers, (first, np.searchsorted(start, edges))):
                    block = np.unique(numbers[at:at + size])
                    block = block[block < templates.hashes.size].tolist()
                    d = int(ts.owners(first, at))
                    for t, share in templates.matches(block):
                        if not templates.marked(t, hashes[at:at + size]):
                            continue
                        out[2 * (lo + d) + 1].append(
                            {"label": templates.labels[t], "start": at - int(first[d]), "size": size, "containment": share})
            kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("containment", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(out[0::2], kind), pa.array(out[1::2], kind)],
                ["doc_id", "n_words", "phrases", "blocks"])

    return (docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
            .mapInArrow(run, f"doc_id long, n_words long, phrases {_FOUND}, blocks {_FOUND}"))


def summary(found: DataFrame) -> DataFrame:
    """Per document: counts and places of the phrases, labels of the phrases and of
    all matches, and the score: 1 with a phrase, else the highest containment."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "blocks.label")).alias("labels"),
        F.coalesce(F.array_max(F.concat("phrases.containment", "blocks.containment")), F.lit(0.0)).alias("score"))
