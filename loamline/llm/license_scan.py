"""License scans: where a text repeats a license notice, how much of it, and which spans.

Method: each template's word 3-grams are winnowed (the smallest hash of every window is kept), and of a
template of at most ``SHORT`` words every pair of neighbouring words is kept; an inverted index leads
from a fingerprint to the templates and positions that hold it. A document's pairs and 3-grams are
looked up there; hits on nearby diagonals of one template make a candidate, and a banded alignment of
the whole template with the words around it reports matched words and span. A short template is
aligned on every diagonal whose band holds a hit, if enough of its words stand there. A copy that
keeps ``GRAM + WINNOW - 1`` = 4 words of a template in a row, or two words of a short one, is always
looked at; one that keeps fewer in a row is not.

Words: lower-cased runs of letters and digits. Spans are code points of the text, end exclusive.
Coverage is matched words over the template's words; matches of at least ``min_coverage`` are
reported, and of overlapping matches only the one of most matched words (then of most coverage, then
the first).

Defined results: null and empty texts hold no license; texts are scanned whole at any length; a
notice that occurs again is reported again; repeated documents give repeated rows; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from loamline.llm.common import as_text, over_batches, pick

GRAM = 3
WINNOW = 2
#: Words up to which all of a template's pairs of words are indexed.
SHORT = 16
#: Words that an alignment may shift to either side, at least; and as a share of the template.
BAND = 4
BAND_SHARE = 0.1
MIN_COVERAGE = 0.8

# Wording of widely used license notices, as their stewards publish it.
TEMPLATES = [
    ("MIT", "released under the mit license", "Released under the MIT License."),
    ("MIT", "licensed under the mit license", "Licensed under the MIT License."),
    ("MIT", "permission notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "short notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "file header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "short notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "file header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "file header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "file header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "permission notice", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "file header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "dedication", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-4.0", "short notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "tag", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "short notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "tag", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "short notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "tag", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "dedication", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-cased words and where each stands."""
    found = list(_WORD.finditer(text))
    return [m.group().lower() for m in found], [m.span() for m in found]


def _hash(gram: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest(" ".join(gram))


def grams_of(words: list[str]) -> Iterator[tuple[str, ...]]:
    return zip(*(words[i:] for i in range(GRAM)), strict=False)


def winnow(words: list[str]) -> list[tuple[int, tuple[str, ...]]]:
    """(position, 3-gram) of the smallest hash of each window, the rightmost of equal ones."""
    grams = list(grams_of(words))
    hashes = [_hash(g) for g in grams]
    kept = set()
    for a in range(max(1, len(grams) - WINNOW + 1)):
        window = range(a, min(a + WINNOW, len(grams)))
        if window:
            kept.add(min(window, key=lambda i: (hashes[i], -i)))
    return [(i, grams[i]) for i in sorted(kept)]


class Index:
    """Templates and the inverted index of their fingerprints."""

    def __init__(self, templates: list[tuple[str, str, str]]):
        self.templates = [(license_id, name, words_of(text)[0]) for license_id, name, text in templates]
        self.index: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for t, (_, _, words) in enumerate(self.templates):
            if len(words) < GRAM:
                raise ValueError(f"a template has at least {GRAM} words: {' '.join(words)!r}")
            for i, gram in enumerate(zip(words, words[1:])) if len(words) <= SHORT else winnow(words):
                self.index[gram].append((t, i))
        self.index = dict(self.index)

    def band(self, t: int) -> int:
        return max(BAND, int(BAND_SHARE * len(self.templates[t][2])))

    def candidates(self, words: list[str], min_coverage: float = MIN_COVERAGE) -> Iterator[tuple[int, int]]:
        """(template, diagonal): document position minus template position of a group of hits."""
        hits: dict[int, list[int]] = defaultdict(list)
        index = self.index
        for grams in (zip(words, words[1:]), grams_of(words)):
            for at, gram in enumerate(grams):
                if gram in index:
                    for t, i in index[gram]:
                        hits[t].append(at - i)
        for t, diagonals in hits.items():
            band, last = self.band(t), None
            pattern = self.templates[t][2]
            if len(pattern) <= SHORT:
                near = {d + o for d in set(diagonals) if self._enough(pattern, words[max(0, d - 2 * band) : max(0, d + 2 * band + len(pattern))], min_coverage) for o in range(-band, band + 1)}
                yield from ((t, d) for d in sorted(near))
                continue
            for d in sorted(set(diagonals)):
                if last is None or d - last > band // 2:
                    yield t, d
                    last = d

    @staticmethod
    def _enough(pattern: list[str], around: list[str], min_coverage: float) -> bool:
        there = set(around)
        return sum(w in there for w in pattern) >= min_coverage * len(pattern)

    def matches(self, text: str, min_coverage: float = MIN_COVERAGE) -> list[tuple[str, str, int, int, float, int, int]]:
        """(license, template, words, matched words, coverage, start, end), by start."""
        words, spans = words_of(text)
        found = []
        for t, diagonal in self.candidates(words, min_coverage):
            license_id, name, pattern = self.templates[t]
            matched, first, last = align(pattern, words, diagonal, self.band(t))
            if matched and matched >= min_coverage * len(pattern):
                found.append((license_id, name, len(pattern), matched, round(matched / len(pattern), 6), spans[first][0], spans[last][1]))
        return _best(found)


def align(pattern: list[str], words: list[str], diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, first and last matched word) of the best alignment within the band.

    Matches gain 2; a word of the template or of the document without a partner costs 1. The words
    of the document before and after the alignment are free.
    """
    n, width = len(pattern), 2 * band + 1
    low = -1 << 30
    # state at (i, offset): i template words done, j = i + diagonal - band + offset document words done
    score = [0 if 0 <= diagonal - band + o <= len(words) else low for o in range(width)]
    info = [(0, -1, -1)] * width  # matched, first, last
    best, best_info = 0, (0, -1, -1)
    for i in range(1, n + 1):
        base = i + diagonal - band
        new, new_info = [low] * width, [(0, -1, -1)] * width
        for o in range(width):
            j = base + o
            if j < 0 or j > len(words):
                continue
            value, have = low, (0, -1, -1)
            if j >= 1 and score[o] > low // 2 and pattern[i - 1] == words[j - 1]:
                matched, first, _ = info[o]
                value, have = score[o] + 2, (matched + 1, j - 1 if first < 0 else first, j - 1)
            elif j >= 1 and score[o] > low // 2 and score[o] - 2 > value:  # one word replaced by another
                value, have = score[o] - 2, info[o]
            if o + 1 < width and score[o + 1] - 1 > value:  # the template's word is missing
                value, have = score[o + 1] - 1, info[o + 1]
            if o and new[o - 1] - 1 > value:  # the document has a word more
                value, have = new[o - 1] - 1, new_info[o - 1]
            new[o], new_info[o] = value, have
        score, info = new, new_info
    for o in range(width):
        if score[o] > low // 2 and (info[o][0], score[o]) > (best_info[0], best):
            best, best_info = score[o], info[o]
    return best_info


def _best(found: list[tuple]) -> list[tuple]:
    kept: list[tuple] = []
    for x in sorted(found, key=lambda x: (-x[3], -x[4], x[5], x[0], x[1])):
        if not any(x[5] < y[6] and y[5] < x[6] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: (x[5], x[6], x[0]))


SCHEMA = "license string, template string, n_words long, n_matched long, coverage double, start long, end long"
_NAMES = ["license", "template", "n_words", "n_matched", "coverage", "start", "end"]


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str, str]] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row a match: doc_id, license, template, n_words, n_matched, coverage, start, end."""
    docs = pick(documents, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    index = Index(TEMPLATES if templates is None else templates)
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, owner = [], []
        for i, text in enumerate(as_text(batch.column("text"))):
            for match in index.matches(text, min_coverage):
                rows.append(match)
                owner.append(i)
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner, pa.int64())), *columns], ["doc_id", *_NAMES])

    return over_batches(docs, step, f"doc_id {kind}, {SCHEMA}")


def brute_force(text: str, min_coverage: float = MIN_COVERAGE, templates: list[tuple[str, str, str]] | None = None) -> list[tuple]:
    """The same by aligning every template at every position; for small fixtures."""
    index = Index(TEMPLATES if templates is None else templates)
    words, spans = words_of(text)
    found = []
    for t, (license_id, name, pattern) in enumerate(index.templates):
        for diagonal in range(-len(pattern), len(words) + 1):
            matched, first, last = align(pattern, words, diagonal, index.band(t))
            if matched and matched >= min_coverage * len(pattern):
                found.append((license_id, name, len(pattern), matched, round(matched / len(pattern), 6), spans[first][0], spans[last][1]))
    return _best(found)
