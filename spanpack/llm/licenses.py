"""Licence notices by conditional compression.

1. **Blocks.** Each place where a text has a telling word pair of a template is
   a candidate for that template: the words around it, some more on either side
   than the template has there.
2. **Compress and rank.** Each block is compressed alone and with the template as
   a zstandard raw dictionary; candidates are ranked by the bytes that the
   template saves.
3. **Confirm down the ranking.** A candidate's block is compared word by word
   with the template, from each of its pairs, and every difference is listed. It is a notice if at least ``COVER`` of the template's
   words stand there in order, with no more other words between them than
   ``COVER`` allows to lack; words with a digit (versions) or in capitals (names
   such as MIT) must all be there. Years, holders and other words around do not
   count against it. A confirmed notice keeps its words; a candidate further
   down whose block reaches into them is ranked anew by what is left of it. No
   candidate is left out: the saving ranks and rejects nothing.

A template's every pair with a word that is no common function word is looked
for, so words that satisfy ``COVER`` are never missed for want of a pair
(templates have ``MIN_WORDS`` words or more). Candidates that save the same are
taken by template, then by place. Null and empty texts hold no notice; rows that
repeat give their notices each; other columns play no part, whatever their
names. Texts are read whole.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of

COVER, MIN_WORDS, LEVEL = 0.8, 4, 3
_WORD = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+\-]*[A-Za-z0-9+]|[A-Za-z0-9]")
_COMMON = frozenset("a an and any as at be by for from if in is it its may no not of on or that the this to under with you your such all are".split())

# Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "MIT": "Released under the MIT License.",
    "MIT permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0 long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


class Scanner:
    """Templates prepared once per task."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names, self.words, self.required, self.dictionaries = list(templates), [], [], []
        self.pairs: dict[tuple[str, str], list[tuple[int, int]]] = {}   # to templates and places in them
        for k, (name, text) in enumerate(templates.items()):
            written = _WORD.findall(text)
            words = [w.lower() for w in written]
            if len(words) < MIN_WORDS:
                raise ValueError(f"template {name} has fewer than {MIN_WORDS} words")
            self.words.append(words)
            self.required.append({i for i, w in enumerate(written) if any(c.isdigit() for c in w) or (len(w) > 1 and w.isupper())})
            plain = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.dictionaries.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=plain, write_content_size=False))
            for j, (a, b) in enumerate(zip(words, words[1:])):
                if a not in _COMMON or b not in _COMMON:
                    self.pairs.setdefault((a, b), []).append((k, j))
        self.counts = [Counter(words) for words in self.words]
        self.least = [math.ceil(COVER * len(words)) for words in self.words]
        self.most = [int(len(words) - COVER * len(words)) for words in self.words]   # other words in between
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def notices(self, text: str) -> list[tuple[str, int, int, float, float, str]]:
        """``(licence, start, end, saved, cover, differences)`` in code points;
        ``saved`` is the share of its block that the template saves."""
        words = " ".join(_WORD.findall(text)).lower().split(" ")
        heap, before, places = [], set(), {}
        for i, pair in enumerate(zip(words, words[1:])):
            hits = self.pairs.get(pair)
            if hits:
                for k, j in hits:
                    places.setdefault(k, []).append((i, j))
                    if (k, i - 1, j - 1) not in before:   # a run of pairs is one candidate
                        heapq.heappush(heap, self._ranked(words, k, i, j, 0, len(words)))
                before = {(k, i, j) for k, j in hits}
        begins, ends, chosen = [], [], []        # of the notices that stand, in order
        while heap:
            *_, k, i, j, lo, hi, saved = heapq.heappop(heap)
            at = bisect(begins, i)
            free_lo, free_hi = ends[at - 1] if at else 0, begins[at] if at < len(begins) else len(words)
            if i < free_lo or i + 1 >= free_hi:
                continue
            if lo < free_lo or hi > free_hi:     # part of the block is another notice by now
                heapq.heappush(heap, self._ranked(words, k, i, j, free_lo, free_hi))
                continue
            # the fullest notice around any of the template's pairs in the block, each compared once
            mine = places[k][bisect(places[k], (lo,)) : bisect(places[k], (hi - 1,))]
            found = [x for y in mine if (x := self._confirm(words, k, *y, free_lo, free_hi)) is not None]
            if found:
                first, last, same, told = max(found, key=lambda x: (x[2], x[0] - x[1], -x[0]))
                begins.insert(at, first)
                ends.insert(at, last + 1)
                chosen.insert(at, (self.names[k], round(saved, 6), round(same / len(self.words[k]), 6), told))
        if not chosen:
            return []
        edges = {*begins, *(e - 1 for e in ends)}
        spans = {x: m.span() for x, m in enumerate(_WORD.finditer(text)) if x in edges}
        return [(name, spans[a][0], spans[b - 1][1], *rest) for a, b, (name, *rest) in zip(begins, ends, chosen)]

    def _block(self, k: int, i: int, j: int, lo: int, hi: int) -> tuple[int, int]:
        """The words around pair ``j`` of template ``k`` at ``i``, within ``lo`` and ``hi``."""
        n, most = len(self.words[k]), self.most[k]
        return max(lo, i - j - most), min(hi, i + n - j + most)

    def _ranked(self, words: list[str], k: int, i: int, j: int, lo: int, hi: int) -> tuple:
        """A candidate's entry on the heap: what saves most bytes comes first."""
        lo, hi = self._block(k, i, j, lo, hi)
        raw = " ".join(words[lo:hi]).encode()
        size = len(self.alone.compress(raw))
        less = size - len(self.dictionaries[k].compress(raw))
        return -less, k, i, j, lo, hi, less / size

    def _confirm(self, words: list[str], k: int, i: int, j: int, lo: int, hi: int) -> tuple[int, int, int, str] | None:
        """``(first, last, words in place, differences)`` of the fullest notice in
        which words ``i`` and ``i + 1`` are the template's ``j`` and ``j + 1``."""
        template, required, least, most = self.words[k], self.required[k], self.least[k], self.most[k]
        n = len(template)
        lo, hi = self._block(k, i, j, lo, hi)
        has = Counter(words[lo:hi])
        if sum(min(c, has[w]) for w, c in self.counts[k].items()) < least:
            return None
        left = _Side(template[:j][::-1], words[lo:i][::-1], [x in required for x in range(j)][::-1])
        right = _Side(template[j + 2 :], words[i + 2 : hi], [x in required for x in range(j + 2, n)])
        best = max(((a + b + 2, -(x - a + y - b), x, y) for a, x in left.ends for b, y in right.ends if x - a + y - b <= most), default=None)
        if best is None or best[0] < least:
            return None
        same, _, x, y = best
        kept = {j: i, j + 1: i + 1, **{j - 1 - t: i - 1 - w for t, w in left.matches(x)}, **{j + 2 + t: i + 2 + w for t, w in right.matches(y)}}
        first, last, places = i - x, i + 1 + y, set(kept.values())
        told = [f"-{w}" for t, w in enumerate(template) if t not in kept] + [f"+{words[w]}" for w in range(first, last + 1) if w not in places]
        return first, last, same, " ".join(told)


class _Side:
    """Longest common subsequences of a template's words on one side of a pair
    with the beginnings of the words there; required words are not left out.
    ``ends``: ``(words in common, words of the text)``, the shortest for each."""

    def __init__(self, template: list[str], words: list[str], required: list[bool]) -> None:
        self.template, self.words = template, words
        never = -len(template) - 1
        self.rows = [[0] * (len(words) + 1)]
        for t, must in zip(template, required):
            up = self.rows[-1]
            row = [never if must else up[0]]
            for y, w in enumerate(words):
                row.append(max(row[y], never if must else up[y + 1], up[y] + 1 if t == w else never))
            self.rows.append(row)
        end = self.rows[-1]
        self.ends = [(c, y) for y, c in enumerate(end) if c >= 0 and (y == 0 or c > end[y - 1])]

    def matches(self, y: int) -> list[tuple[int, int]]:
        x, out = len(self.template), []
        while x and y:
            here = self.rows[x][y]
            if self.template[x - 1] == self.words[y - 1] and here == self.rows[x - 1][y - 1] + 1:
                x, y = x - 1, y - 1
                out.append((x, y))
            elif here == self.rows[x][y - 1]:
                y -= 1
            else:
                x -= 1
        return out


def licence_notices(docs: DataFrame, templates: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, license, start, end, saved, cover, differences)``: a row for
    each confirmed notice."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = src.drop("text").schema.add("license", "string").add("start", "long").add("end", "long").add("saved", "double").add("cover", "double").add("differences", "string")
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(k, *n) for k, t in enumerate(texts_of(part, "text")) for n in scanner.notices(t)]
                cols = [part.column(0).take(pa.array([f[0] for f in found], pa.int64()))]
                cols += [pa.array([f[c + 1] for f in found], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)
