"""License scans by patience alignment.

A text region and a template are aligned on the words that occur once in both: the longest run of
such anchors in increasing order is kept, and the gaps between them are aligned the same way, where
more words are unique. Coverage is the part of the template's words that is aligned.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm._frames import Workspace
from ledgerloom.llm.decontaminate import lowered

COVERAGE = 0.8
WINDOW = 2  # a region is at most about so many times as long as its template

# Notices as licensors publish them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                         "permissions and limitations under the License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                      "option) any later version.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                      "option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                       "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                       "(at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                       "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                       "(at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                      "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "BSD-clauses": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                   "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                   "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-text": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                         "products derived from this software without specific prior written permission.",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
               "this software to the public domain worldwide. This software is distributed without any warranty.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                 "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                 "commercial or non-commercial, and by any means.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                "following conditions are met:",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
MATCHES = "doc_id bigint, license string, coverage double, start bigint, end bigint"


class Template(NamedTuple):
    name: str
    words: list[str]
    vocabulary: frozenset[str]


class Match(NamedTuple):
    start: int
    end: int
    coverage: float
    name: str
    matched: int


def template_of(name: str, text: str) -> Template:
    words = WORD.findall(lowered(text))
    return Template(name, words, frozenset(words))


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence of distinct values."""
    ends, at, before = [], [], []
    for index, value in enumerate(values):
        place = bisect.bisect_left(ends, value)
        before.append(at[place - 1] if place else -1)
        ends[place:place + 1], at[place:place + 1] = [value], [index]
    chain, index = [], at[-1] if at else -1
    while index >= 0:
        chain.append(index)
        index = before[index]
    return chain[::-1]


def aligned(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places in text and template, in increasing order, by patience alignment."""
    pairs, work = [], [(0, len(text), 0, len(template))]
    while work:
        low, high, first, last = work.pop()
        while low < high and first < last and text[low] == template[first]:
            pairs.append((low, first))
            low, first = low + 1, first + 1
        while low < high and first < last and text[high - 1] == template[last - 1]:
            high, last = high - 1, last - 1
            pairs.append((high, last))
        if low == high or first == last:
            continue
        here, there = Counter(text[low:high]), Counter(template[first:last])
        places = {text[at]: at for at in range(low, high) if here[text[at]] == 1}
        unique = [(places[template[at]], at) for at in range(first, last) if there[template[at]] == 1 and template[at] in places]
        anchors = [unique[index] for index in increasing([place for place, _ in unique])]
        if not anchors:
            continue
        pairs.extend(anchors)
        bounds = [(low - 1, first - 1), *anchors, (high, last)]
        work.extend((a + 1, b, c + 1, d) for (a, c), (b, d) in zip(bounds, bounds[1:], strict=False))
    return sorted(pairs)


def least_different(template: Template, coverage: float) -> int:
    """Fewest different words of the template in any text that reaches the coverage.

    Each word of the template that is not aligned takes away one different word at most.
    """
    return len(template.vocabulary) - (len(template.words) - math.ceil(coverage * len(template.words)))


def regions(words: list[str], template: Template, coverage: float) -> Iterator[tuple[int, int]]:
    """Parts of the text in which some window holds enough different words of the template.

    Every region that could reach the coverage is given: aligned words are words of the template, and those that are
    not aligned take away at most as many different ones.
    """
    hits = [at for at, word in enumerate(words) if word in template.vocabulary]
    width, least = WINDOW * len(template.words) + 8, max(1, least_different(template, coverage))
    inside: Counter[str] = Counter()
    first, begin, end = 0, None, None
    for at in hits:
        inside[words[at]] += 1
        while at - hits[first] >= width:
            word = words[hits[first]]
            inside[word] -= 1
            if not inside[word]:
                del inside[word]
            first += 1
        if len(inside) >= least:
            if begin is not None and hits[first] > end:
                yield begin, end
                begin = None
            begin = hits[first] if begin is None else begin
            end = at + 1
    if begin is not None:
        yield begin, end


def _notices(words: list[str], template: Template, coverage: float) -> Iterator[Match]:
    """Matches of one template, also several in one region."""
    work = list(regions(words, template, coverage))
    while work:
        low, high = work.pop()
        pairs = aligned(words[low:high], template.words)
        places = [low + place for place, _ in pairs]
        width, best = WINDOW * len(template.words), (0, 0, 0)
        for right, place in enumerate(places):
            left = bisect.bisect_left(places, place - width + 1)
            best = max(best, (right - left + 1, -places[left], -place))
        if best[0] >= coverage * len(template.words):
            start, end = -best[1], -best[2] + 1
            yield Match(start, end, best[0] / len(template.words), template.name, best[0])
            work += [(a, b) for a, b in ((low, start), (end, high)) if b - a >= coverage * len(template.words)]
        elif high - low > width:
            # repeated words hide anchors: look at overlapping parts of a window's length
            step = max(1, len(template.words) // 2)
            work += [(at, min(high, at + width)) for at in range(low, high, step) if min(high, at + width) - at < high - low]


def licenses_in(text: str, templates: list[Template], coverage: float = COVERAGE) -> list[Match]:
    """Notices of a text; of those that overlap, the one with most aligned words, then coverage, then name."""
    plain = lowered(text)
    words = WORD.findall(plain)
    present = set(words)
    found = [match for template in templates if len(template.vocabulary & present) >= least_different(template, coverage)
             for match in _notices(words, template, coverage)]
    kept: list[Match] = []
    for match in sorted(set(found), key=lambda m: (-m.matched, -m.coverage, m.start, m.end, m.name)):
        if all(match.end <= other.start or other.end <= match.start for other in kept):
            kept.append(match)
    if not kept:
        return []
    spans = [match.span() for match in WORD.finditer(plain)]
    return [match._replace(start=spans[match.start][0], end=spans[match.end - 1][1]) for match in sorted(kept)]


def license_notices(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Every license notice of every document: ``doc_id, license, coverage, start, end`` (code points, end exclusive).

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Words are compared in lower case without punctuation.
    A null or empty text has no notice. Rows that repeat an id, also a null one, are scanned one by one. An
    empty table gives no rows. Only words A-Z and digits count, also in other languages.
    """
    Workspace(docs.sparkSession, "licenses")
    known = [template_of(name, text) for name, text in (templates or TEMPLATES).items()]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, match.name, match.coverage, match.start, match.end)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    if text for match in licenses_in(text, known, coverage)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                             ["doc_id", "license", "coverage", "start", "end"])
    return docs.select("doc_id", "text").mapInArrow(over, MATCHES)
