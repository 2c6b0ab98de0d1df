"""License scans: an exact set-similarity join of text blocks against licence templates.

A template (its set of words T) is contained in a block (its set of words B) when
``|T & B| >= threshold * |T|``.  Blocks are the lines, and for notices that are wrapped every run of
consecutive words over two or more lines, of at most ``1 / threshold`` times the template's words
(with repeats).  Runs that overlap count once, as the best of them, and only if they hold more of
the template than each of their lines does.  Template words are ordered by their frequency over all blocks
of the corpus, rarest first (ties by the word), and three exact filters are applied before any
set is intersected:

* prefix: to reach the threshold, a block must hold one of the first
  ``|T| - ceil(threshold |T|) + 1`` words of T;
* length: ``|B| >= ceil(threshold |T|)`` words;
* position: T is walked in order; at place i at most ``|T| - i`` more words can match, so the walk
  stops as soon as that cannot reach the threshold.

A match must also hold the words that name the template's licence (``REQUIRED``): the threshold
alone lets one word of a short template be missing, be it the name.

Runs use the same filters: only the words around the places of a prefix word are walked, of texts
that hold enough of T's words at all.

The template list is a parameter of fixed size; the only corpus statistic that reaches the
driver is one count for each template word.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows are
judged one by one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import WORD, alnum_words, batch_of, text_key, texts

THRESHOLD = 0.8
# Phrases of the base result and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Short standard notices (label, text).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met"),
    ("bsd-3", "SPDX-License-Identifier: BSD-3-Clause"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the "
              "GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]
# The words that name the licence, by template; a block without one of them is no match.
REQUIRED = {
    "Released under the MIT License": "mit",
    "Licensed under the Apache License, Version 2.0": "apache 2",
    "SPDX-License-Identifier: Apache-2.0": "apache 2",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd 3",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mozilla",
    "Licensed under CC BY-NC 4.0": "cc nc",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "noncommercial",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "attribution",
}
FOUND = pa.schema([("n_words", pa.int64()), ("places", pa.list_(pa.int64())), ("base", pa.list_(pa.string())),
                   ("matches", pa.list_(pa.struct([("label", pa.string()), ("line", pa.int64()),
                                                   ("containment", pa.float64())])))])
DDL = ("n_words long, places array<long>, base array<string>, "
       "matches array<struct<label:string,line:long,containment:double>>")


def word_counts(docs: DataFrame, wanted: frozenset[bytes]) -> dict[bytes, int]:
    """Number of lines of the corpus that hold each wanted word."""
    def task(batches):
        count = dict.fromkeys(wanted, 0)
        for b in batches:
            for t in texts(b.column("text")):
                for line in t.split(b"\n"):
                    for w in wanted.intersection(alnum_words(line)):
                        count[w] += 1
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in count], "n": list(count.values())})

    rows = docs.select("text").mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word.encode(): r.n for r in rows.collect()}


class Index:
    """Templates by the words of their prefixes."""

    def __init__(self, templates, threshold: float, frequency: dict[bytes, int], required: dict[str, str]):
        self.templates, self.by_word, self.longest, self.names = [], {}, [], []
        for label, text in templates:
            words = sorted(set(alnum_words(text.encode())), key=lambda w: (frequency.get(w, 0), w))
            need = ceil(threshold * len(words) - 1e-9)
            for w in words[:len(words) - need + 1]:
                self.by_word.setdefault(w, []).append(len(self.templates))
            self.templates.append((label, words, need))
            self.names.append(frozenset(alnum_words(required.get(text, "").encode())))
            self.longest.append(ceil(len(alnum_words(text.encode())) / threshold - 1e-9))
        self.first = frozenset(self.by_word)

    def match(self, block: set[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of each template the block holds"""
        found, tried = [], set()
        for w in self.first & block:
            for k in self.by_word[w]:
                label, words, need = self.templates[k]
                if k in tried or len(block) < need or not self.names[k] <= block:
                    continue
                tried.add(k)
                n = 0
                for at, x in enumerate(words):
                    if n + len(words) - at < need:
                        break
                    n += x in block
                if n >= need:
                    found.append((k, n / len(words)))
        return found

    def runs(self, words: list[bytes], own: set[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, place of the first word, place of the last, containment) of each shortest run of
        at most the template's longest that meets it"""
        found = []
        for k in sorted({k for w in self.first & own for k in self.by_word[w]}):
            label, wanted, need = self.templates[k]
            if sum(w in own for w in wanted) < need or not self.names[k] <= own:
                continue
            most, wanted_set, prefix = self.longest[k], set(wanted), set(wanted[:len(wanted) - need + 1])
            near, upto = [], 0               # places of template words around the places of prefix words
            for i, w in enumerate(words):
                if w in prefix:
                    near += [j for j in range(max(upto, i - most + 1), min(len(words), i + most)) if words[j] in wanted_set]
                    upto = min(len(words), i + most)
            count, left = {}, 0
            for i in near:
                count[words[i]] = count.get(words[i], 0) + 1
                while near[left] <= i - most or count[words[near[left]]] > 1:
                    w = words[near[left]]
                    count[w] -= 1
                    if not count[w]:
                        del count[w]
                    left += 1
                if len(count) >= need and self.names[k] <= count.keys():
                    found.append((k, near[left], i, len(count) / len(wanted)))
        return found


def wrapped(runs, by_line: dict[tuple[int, int], float], starts: list[int]) -> list[tuple[int, int, float]]:
    """(template, line of the first word, containment) of the runs over several lines that hold more of
    the template than their lines do; the best of those that overlap.  starts: words before each line."""
    best, last = [], (-1, -1)                # template and last place of the runs that overlap so far
    for k, a, b, c in runs:
        i, j = bisect_right(starts, a) - 1, bisect_right(starts, b) - 1
        if i == j or any(by_line.get((k, x), 0.0) >= c for x in range(i, j + 1)):
            continue
        if last[0] == k and a <= last[1]:
            if c > best[-1][2]:
                best[-1] = (k, i, c)
        else:
            best.append((k, i, c))
        last = (k, b)
    return best


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(place of the first word, label) wherever a phrase's words stand consecutively."""
    norm, found = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        p = b" " + phrase.encode() + b" "
        at = norm.find(p)
        while at >= 0:
            found.append((norm.count(b" ", 0, at), label))
            at = norm.find(p, at + 1)
    return found


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD,
                 required=REQUIRED) -> DataFrame:
    """doc_id, n_words, places (starts of phrases, in words), base (their labels) and matches
    (label, line and containment of every line, or run of words from that line on, that meets a
    template)."""
    vocabulary = frozenset(w for _, t in templates for w in alnum_words(t.encode()))
    frequency = word_counts(docs, vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), *FOUND])

    def task(batches):
        index = Index(templates, threshold, frequency, required)
        for b in batches:
            rows = []
            for t in texts(b.column("text")):
                words = t.translate(WORD).split()
                own = set(words)
                base = phrase_places(words, phrases) if any(p.encode().split()[-1] in own for p in phrases) else []
                matches = []
                if index.first & own:
                    lines = [alnum_words(line) for line in t.split(b"\n")]
                    hits = [(k, i, c) for i, line in enumerate(lines) for k, c in index.match(set(line))]
                    if len(lines) > 1 and (runs := index.runs(words, own)):
                        starts = [0, *accumulate(map(len, lines))][:-1]
                        hits += wrapped(runs, {(k, i): c for k, i, c in hits}, starts)
                    matches = [{"label": index.templates[k][0], "line": i, "containment": c}
                               for k, i, c in sorted(hits, key=lambda x: x[1])]
                rows.append((len(words), sorted(p for p, _ in base), sorted({x for _, x in base}), matches))
            yield batch_of(schema, [b.column("doc_id"), *([list(x) for x in zip(*rows)] if rows else [[]] * 4)])

    return docs.select(F.col("doc_id").cast("long"), text_key().alias("text")).mapInArrow(task, f"doc_id long, {DDL}")


def digest(rows: DataFrame) -> DataFrame:
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("matches", lambda m: m["label"]))))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))
