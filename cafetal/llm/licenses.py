"""License scan: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import column, slices

# UTF-8 view of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: every byte of a non-ASCII character is above 7F.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall

# Phrases of the contract and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of common license notices and texts.  What follows a slash tells variants of a label apart.
TEMPLATES = {
    "agpl-3.0": "licensed under the GNU Affero General Public License, version 3",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-4.0/short": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-4.0/long": "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc-by-sa-4.0/long": "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl": "licensed under the GNU Lesser General Public License",
    "mit": "Released under the MIT License",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files, to deal in the Software without restriction",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                "conditions: The above copyright notice and this permission notice shall be included in all copies or "
                "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
                "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
                "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
                "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
                "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
            "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
            "software for any purpose, including commercial applications, and to alter it and redistribute it freely",
}

# Families of licenses (a word that all their templates hold one of) and the words that tell siblings apart.
FAMILIES = [(("gnu",), ("affero", "lesser")),
            (("cc", "creative"), ("nc", "noncommercial", "sa", "sharealike", "nd", "noderivatives"))]


def words(text: str) -> list[bytes]:
    return _WORDS(text.encode().lower())


class TemplateIndex:
    """Prefix index of the templates, their tokens in the order of rising frequency in the corpus."""

    def __init__(self, templates: dict[str, str], threshold: float, frequency: dict[bytes, int]):
        sets = {name: set(words(t)) for name, t in templates.items()}
        order = sorted(set().union(*sets.values()), key=lambda w: (frequency.get(w, 0), w)) if sets else []
        self.rank = {w: k for k, w in enumerate(order)}
        self.templates = {name: [self.rank[w] for w in sorted(s, key=self.rank.get)] for name, s in sets.items() if s}
        # tokens that must be common; the small term keeps 0.8 * 5 at 4
        self.need = {n: max(1, math.ceil(threshold * len(t) - 1e-9)) for n, t in self.templates.items()}
        self.prefix: dict[int, list[str]] = {}
        for name, t in self.templates.items():
            for w in t[:len(t) - self.need[name] + 1]:
                self.prefix.setdefault(w, []).append(name)
        self.triggers = {order[k] for k in self.prefix}
        # words of a block: as many as the template's at the threshold's share
        self.longest = {n: math.ceil(len(words(templates[n])) / threshold - 1e-9) for n in self.templates}
        # words that must stand in a block, and those that must not
        self.marks = {}
        for n in self.templates:
            own = [marks for heads, marks in FAMILIES if any(h.encode() in sets[n] for h in heads)]
            marks = {m.encode() for ms in own for m in ms}
            self.marks[n] = marks & sets[n], marks - sets[n]

    def _stretches(self, name: str, hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(distinct tokens, first word, last word) of blocks that match; of blocks that overlap the best.

        ``hits`` are the places of the template's tokens, as (word number, rank).
        """
        template, need, longest = self.templates[name], self.need[name], self.longest[name]
        place = {w: i for i, w in enumerate(template)}
        prefix = len(template) - need + 1
        found = []
        at = [i for i, _ in hits]
        start = 0
        for i, w in hits:
            if place[w] >= prefix or i < start:
                continue
            # prefix filter: a matching block holds a prefix token, so it lies around one (or a chain of them)
            low, high = i - longest + 1, i + longest
            while (more := [j for j, x in hits[bisect_left(at, i):bisect_left(at, high)] if place[x] < prefix][-1] + longest) > high:
                high = more
            start = high
            part = hits[bisect_left(at, low):bisect_left(at, high)]
            if len(part) < need:  # length filter
                continue
            # positional filter: no more can be common than the tokens from the rarest one here on
            if len(template) - min(place[x] for _, x in part) < need:
                continue
            inside: Counter = Counter()
            left = 0
            for j, x in part:
                inside[x] += 1
                while j - part[left][0] >= longest or inside[part[left][1]] > 1:
                    y = part[left][1]
                    inside[y] -= 1
                    if not inside[y]:
                        del inside[y]
                    left += 1
                if len(inside) >= need:
                    found.append((-len(inside), j - part[left][0], part[left][0], j))
        chosen: list[tuple[int, int, int]] = []
        for n, _, first, last in sorted(found):
            k = bisect_left(chosen, (first,))
            if (k == len(chosen) or chosen[k][0] > last) and (k == 0 or chosen[k - 1][1] < first):
                chosen.insert(k, (first, last, -n))
        return [(n, first, last) for first, last, n in chosen]

    def matches(self, ws: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, words, containment) of the blocks of a text, wherever its lines break."""
        hits = [(i, self.rank[w]) for i, w in enumerate(ws) if w in self.rank]
        present = {w for _, w in hits}
        out = set()
        for name in {name for w in present for name in self.prefix.get(w, ())}:
            template = set(self.templates[name])
            if len(template & present) < self.need[name]:
                continue
            must, may_not = self.marks[name]
            for n, first, last in self._stretches(name, [h for h in hits if h[1] in template]):
                block = set(ws[first:last + 1])
                if must <= block and not may_not & block:
                    out.add((name.split("/")[0], first, last - first + 1, n / len(template)))
        return sorted(out, key=lambda m: (m[1], m[2], m[0], m[3]))


def _frequencies(vocabulary: frozenset[bytes]):
    def run(batches):
        counts: Counter = Counter()
        for b in slices(batches):
            for text in column(b, "__body"):
                counts.update(vocabulary.intersection(words(text)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], names=["w", "n"])

    return run


_FIELDS = ("label", "first_word", "words", "containment")
_MATCH = pa.struct(zip(_FIELDS, (pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True))


def _scan(index: TemplateIndex, phrases: dict[str, str]):
    by_first: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for p, label in phrases.items():
        by_first.setdefault(words(p)[0], []).append((words(p), label))
    firsts = frozenset(by_first)

    def one(text: str):
        ws = words(text)
        places, labels, matches = [], set(), []
        if not firsts.isdisjoint(ws):
            for i, w in enumerate(ws):
                for phrase, label in by_first.get(w, ()):
                    if ws[i:i + len(phrase)] == phrase:
                        places.append(i)
                        labels.add(label)
        if not index.triggers.isdisjoint(ws):
            matches = index.matches(ws)
        return len(ws), len(places), min(places, default=None), max(places, default=None), sorted(labels), matches

    def run(batches):
        for b in slices(batches):
            rows = [one(t) for t in column(b, "__body")]
            n, base, first, last, labels, matches = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(base, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(labels, pa.list_(pa.string())),
                 pa.array([[dict(zip(_FIELDS, m, strict=True)) for m in ms] for ms in matches], pa.list_(_MATCH))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "matches"])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8,
                  phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License phrases and license templates found in every whole text.

    A block is a stretch of words of at most 1 / ``threshold`` times the template's words, wherever lines
    break.  It matches a template if it holds at least ``threshold`` of the template's distinct words; of blocks that
    overlap, the one with most of them, then the shortest, then the first is reported.  Siblings that differ
    by a word (Affero, Lesser, NC, SA) are told apart by it: a block must hold just those of
    its family's marks that the template holds.  Tokens are ordered by the number of
    documents of this corpus that hold them, rarest first; a block can only match
    around a token of a template's prefix, and length and positional bounds rule
    out further stretches before the count.  The join is exact.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_base`` (places of
    ``phrases``, across lines), ``first_word``, ``last_word`` (null without any),
    ``base`` (labels of phrases), ``matches`` (label, first_word, words,
    containment).  A null or empty text has no words and no matches; null ids are
    passed on; other columns are not carried.

    Plan: two scans, no shuffle of texts.  The first counts the templates' own
    tokens (a bounded vocabulary; partial counts per task); the second joins.
    """
    base = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(text_col, F.lit("")).alias("__body"))
    vocabulary = frozenset(w for t in templates.values() for w in words(t))
    counts = (base.mapInArrow(_frequencies(vocabulary), "w string, n long")
              .groupBy("w").agg(F.sum("n").alias("n")).collect())  # at most the templates' vocabulary
    index = TemplateIndex(templates, threshold, {r.w.encode(): r.n for r in counts})
    return base.mapInArrow(
        _scan(index, phrases),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, "
        "matches array<struct<label:string,first_word:long,words:long,containment:double>>")


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns; the score is the best containment, 1 where a phrase stands."""
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    every = F.array_sort(F.array_distinct(F.concat("base", F.transform("matches", lambda m: m["label"]))))
    return result.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                         F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                         F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"))
