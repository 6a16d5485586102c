"""License texts and notices in documents, by patience alignment.

A text is compared with a license template by anchors: words that occur exactly
once in both. Of these the longest increasing subsequence is kept, and the gaps
between them are aligned the same way; equal words at the ends of a gap are
matched first. The share of the template's words that are matched is the
coverage.

A text is aligned where it can contain a license: every line with a telling word
(a template word that is no function word) by itself, so that repeated notices
do not spoil each other's anchors, and every stretch of such lines, for licenses
that run over many lines. Lines are whole; nothing is cut. Where a license may
stand several times in one of these, its words repeat and are no anchors, so
windows of the template's length around its rarest words are aligned as well:
so many of its words that a place that is covered enough has one of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# share of a template that has to be found
MIN_COVERAGE = 0.85
# lines without telling words that a stretch may run over
_BRIDGE = 2

# public license texts and the notices that point to licenses
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "BSD notice": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "All rights reserved": "All rights reserved.",
}

# words that say nothing about licenses by themselves
_FUNCTION = frozenset(
    "a all an and any are as at be but by for from in is it its no not of on or other so that the this to use with without "
    "you your may can will if do above under out following even either later must work free person hope useful".split()
)


def words_of(text: str, pattern: re.Pattern) -> list[str]:
    return pattern.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by the first, in which the second rises (patience sorting)."""
    tops: list[int] = []
    holders: list[int] = []
    previous = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        previous[i] = holders[k - 1] if k else -1
        if k == len(tops):
            tops.append(b)
            holders.append(i)
        else:
            tops[k], holders[k] = b, i
    out, at = [], holders[-1] if holders else -1
    while at >= 0:
        out.append(pairs[at])
        at = previous[at]
    return out[::-1]


def _once(words: list[str], low: int, high: int) -> dict[str, int]:
    """Place of every word that occurs once between two places."""
    seen: dict[str, int] = {}
    for i in range(low, high):
        seen[words[i]] = -1 if words[i] in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched places of text and template, both rising."""
    out, open_ = [], [(0, len(text), 0, len(template))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        theirs = _once(template, c, d)
        anchors = _increasing(sorted((i, theirs[w]) for w, i in _once(text, a, b).items() if w in theirs))
        if not anchors:
            continue
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            open_.append((i + 1, k, j + 1, m))
        out += anchors
    return sorted(out)


def _windows(words: list[str], template: list[str], least: float) -> list[tuple[float, int, int]]:
    """``(coverage, first word, word after the last)`` of every window that is covered enough."""
    size = len(template)
    places: dict[str, list[int]] = {w: [] for w in template}
    for i, w in enumerate(words):
        if w in places:
            places[w].append(i)
    # a place misses fewer of the template's words than these
    rarest = sorted(range(size), key=lambda j: len(places[template[j]]))[: int((1 - least) * size + 1e-9) + 1]
    found = []
    for start in sorted({i - j for j in rarest for i in places[template[j]]}):
        # as long as the template, or with room for words put in or left out
        for room in (0, size // 4 + 1):
            low, high = max(start - room, 0), start + size + room
            own = words[low:high]
            there = set(own)
            if sum(w in there for w in template) < least * size:
                continue
            matched = align(own, template)
            if len(matched) >= least * size:
                found.append((len(matched) / size, low + matched[0][0], low + matched[-1][0] + 1))
                if len(matched) == size:
                    break
    return found


def _apart(found: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """Places that do not overlap, the best covered (then the shortest, then the first) of those that do."""
    kept: list[tuple[float, int, int]] = []
    starts: list[int] = []
    for share, first, last in sorted(set(found), key=lambda f: (-f[0], f[2] - f[1], f[1])):
        at = bisect_left(starts, first)
        if (at == 0 or kept[at - 1][2] <= first) and (at == len(kept) or last <= kept[at][1]):
            starts.insert(at, first)
            kept.insert(at, (share, first, last))
    return kept


def places_of(words: list[str], template: list[str], least: float) -> list[tuple[float, int, int]]:
    """``(coverage, first word, word after the last)`` of every place of a template in words, in order."""
    matched = align(words, template)
    share = len(matched) / len(template)
    whole = [(share, matched[0][0], matched[-1][0] + 1)] if matched and share >= least else []
    if whole and len(words) < 2 * least * len(template):
        return whole
    found = _apart(_windows(words, template, least))
    # what is aligned as a whole may run over several places; it stands for one that it covers better
    for share, first, last in whole:
        over = [f for f in found if f[1] < last and first < f[2]]
        if not over or len(over) == 1 and share > over[0][0]:
            found = sorted([f for f in found if f not in over] + whole, key=lambda f: f[1])
    return found


def find_in(text: str, templates: dict[str, list[str]], telling: dict[str, set[str]], pattern: re.Pattern, least: float):
    """``(license, coverage, first word, word after the last, places)`` of every license in a text."""
    every = set().union(*telling.values())
    if not every & set(words_of(text, pattern)):
        return []
    lines, at, spans = [], 0, []
    for line in re.split(r"[\n\r]+", text):
        words = words_of(line, pattern)
        lines.append((at, words, every.intersection(words)))
        at += len(words)
    run: list[int] = []
    for i, (_, _, found) in enumerate(lines):
        if found:
            if run and i - run[-1] > _BRIDGE + 1:
                spans.append((run[0], run[-1]))
                run = []
            run.append(i)
    spans.append((run[0], run[-1]))
    candidates = {(i, i) for a, b in spans for i in range(a, b + 1) if lines[i][2]} | set(spans)
    every_place: dict[str, list] = {}
    seen: dict[tuple, list] = {}
    for a, b in sorted(candidates):
        words = [w for _, own, _ in lines[a : b + 1] for w in own]
        found = set().union(*(f for _, _, f in lines[a : b + 1]))
        key = tuple(words) if a == b else (a, b)
        if key not in seen:
            seen[key] = []
            for name, template in templates.items():
                # coverage is at most the share of the template's words that are there
                if not found & telling[name]:
                    continue
                there = set(words)
                if sum(w in there for w in template) < least * len(template):
                    continue
                seen[key] += [(name, *place) for place in places_of(words, template, least)]
        start = lines[a][0]
        for name, share, first, last in seen[key]:
            every_place.setdefault(name, []).append((share, start + first, start + last))
    best = []
    for name, found in every_place.items():
        found = _apart(found)
        best.append((name, *min(found, key=lambda f: (-f[0], f[1])), found))
    # a license whose text is the beginning of a longer one found at the same place is not there by itself
    longer = {n: f for n, _, _, _, f in best}
    inside = lambda name, place: any(
        other != name and templates[other][: len(templates[name])] == templates[name] and any(a <= place[1] and place[2] <= b for _, a, b in found)
        for other, found in longer.items()
    )
    apart = []
    for name, _, _, _, found in best:
        found = [f for f in found if not inside(name, f)]
        if found:
            apart.append((name, *min(found, key=lambda f: (-f[0], f[1])), found))
    return sorted(apart, key=lambda f: (-f[1], -len(templates[f[0]]), f[0]))


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = MIN_COVERAGE, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``licenses``: every license that is found, the best covered first.

    An array of ``(license, coverage, first_word, last_word, places)``; the words counted are
    runs of letters and digits, A-Z as a-z, and ``last_word`` is the one after the
    last. Of several places of one license these are the best covered (then the
    first); ``places`` has the same three of every place, in order, none overlapping
    another. A license that only begins a longer one, found where it stands, is not
    listed. Equal coverages are in the order of the templates' length, then name. Null and empty
    texts and texts without licenses have an empty array. All columns stay as they are.
    """
    templates = templates or TEMPLATES
    shared = docs.sparkSession.sparkContext.broadcast(templates)
    function = _FUNCTION

    def look(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pattern = re.compile(r"[^\W_]+")
        given = {name: words_of(text, pattern) for name, text in shared.value.items()}
        telling = {name: {w for w in words if w not in function and not w.isdigit()} for name, words in given.items()}
        for texts in columns:
            out = []
            for text in texts:
                found = find_in(text, given, telling, pattern, least)
                out.append([
                    {"license": n, "coverage": s, "first_word": a, "last_word": b,
                     "places": [{"coverage": t, "first_word": c, "last_word": d} for t, c, d in every]}
                    for n, s, a, b, every in found
                ])
            yield pd.Series(out, dtype=object)

    place = "coverage: double, first_word: long, last_word: long"
    udf = F.pandas_udf(look, f"array<struct<license: string, {place}, places: array<struct<{place}>>>>")
    return docs.withColumn("licenses", udf(F.coalesce(F.col(text_col), F.lit(""))))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    best = F.get("licenses", F.lit(0))
    return scan(docs).select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        best["license"].alias("license"),
        best["coverage"].alias("coverage"),
        best["first_word"].alias("first_word"),
        best["last_word"].alias("last_word"),
        F.array_join(F.array_sort(F.col("licenses.license")), ",").alias("found"),
    )
