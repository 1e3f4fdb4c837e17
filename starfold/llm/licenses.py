"""License scans by patience alignment.

A text is compared with each license notice word by word: words found once in
the text and once in the notice are anchors, the longest increasing
subsequence of the anchors (by patience sorting) keeps those in common order,
and the gaps between them are aligned in the same way, with what is unique
inside the gap. Runs equal at the ends of a gap are matched before. The share
of the notice's words that are aligned is the coverage.

A long text holds a notice in a small part, and its words are no longer unique
over the whole text. So the text is first cut to the places that can hold a
notice: stretches where enough words of the notice lie close together. The
test is exact: a stretch left out can't reach the least coverage.

Spark partitions the texts; each task compares its own. Notices are a parameter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame, functions as F

from .words import add_columns

LEAST = 0.8            # coverage from which a notice counts as found
SLACK = 1.5            # a notice is looked for in stretches of up to so many times its own number of words

# Short notices of common licenses.
NOTICES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
}

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-cased words (letters and digits, inner dots and hyphens) and their spans in the text."""
    found = [(m.group().lower(), m.span()) for m in _WORD.finditer(text)]
    return [w for w, _ in found], [s for _, s in found]


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (sorted by the first) that rises in the second, by patience sorting."""
    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        back.append(top_at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = y, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), rising in both. Gaps wait on a list, so depth is no limit."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = longest_increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place])
        out += anchors
        edge = (a0, b0)
        for i, j in [*anchors, (a1, b1)] if anchors else []:
            gaps.append((edge[0], i, edge[1], j))
            edge = (i + 1, j + 1)
    return sorted(out)


def needed(notice: list[str], least: float) -> int:
    """How many words of a notice are ``least`` of it, without the rounding of binary fractions."""
    return ceil(len(notice) * Fraction(str(least)))


def stretches(text: list[str], notice: list[str], least: float, slack: float = SLACK) -> list[tuple[int, int]]:
    """Parts of the text, apart from each other, that hold every window of ``slack`` times the notice's length
    in which at least ``least`` of the notice's words occur (each as often as in the notice at most)."""
    wanted = Counter(notice)
    need, width = needed(notice, least), max(len(notice), int(len(notice) * slack))
    at = [i for i, w in enumerate(text) if w in wanted]
    if len(at) < need:
        return []
    have, total, first, out = Counter(), 0, 0, []
    for last, i in enumerate(at):
        have[text[i]] += 1
        total += have[text[i]] <= wanted[text[i]]
        while at[first] <= i - width:
            w = text[at[first]]
            total -= have[w] <= wanted[w]
            have[w] -= 1
            first += 1
        if total >= need:
            start = at[first]
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def starts(text: list[str], a: int, b: int, notice: list[str], need: int, width: int) -> list[int]:
    """Places in a..b-1 where a find may begin: words that can be the first of ``need`` in order, with ``need`` words
    of the notice (each as often as there at most) within ``width`` words from there on."""
    wanted, firsts = Counter(notice), set(notice[:len(notice) - need + 1])
    have, total, end, out = Counter(), 0, a, []
    for s in range(a, b - need + 1):
        while end < min(b, s + width):
            have[text[end]] += 1
            total += have[text[end]] <= wanted[text[end]]
            end += 1
        if total >= need and text[s] in firsts:
            out.append(s)
        total -= have[text[s]] <= wanted[text[s]]
        have[text[s]] -= 1
    return out


def scan(text: str, notices: dict[str, list[str]], least: float = LEAST) -> list[tuple[str, float, int, int]]:
    """(name, coverage, start, end) of the notices in a text, characters start..end-1; ordered by start, end, name.

    In a stretch that holds several copies the words aren't unique; it is then
    searched from every word that a find may begin with, and the best of
    overlapping finds stays.
    """
    vocabulary, out = set(_WORD.findall(text.lower())), []
    has, spans = None, None
    for name, notice in notices.items():
        need = needed(notice, least)
        if not notice or sum(w in vocabulary for w in notice) < need:
            continue
        if has is None:
            has, spans = words(text)
        width = max(len(notice), int(len(notice) * SLACK))
        for a, b in stretches(has, notice, least):
            found = set()
            for s in starts(has, a, b, notice, need, width) if b - a > width else [a]:
                pairs = align(has[s:min(b, s + width)], notice)
                if len(pairs) >= need:
                    found.add((-len(pairs), pairs[-1][0] - pairs[0][0], s + pairs[0][0], s + pairs[-1][0]))
            taken: list[tuple[int, int]] = []       # apart from each other, by place
            for cover, _, i, j in sorted(found):
                at = bisect_left(taken, (i, i))
                if (at == 0 or taken[at - 1][1] < i) and (at == len(taken) or j < taken[at][0]):
                    taken.insert(at, (i, j))
                    out.append((name, -cover / len(notice), spans[i][0], spans[j][1]))
    return sorted(out, key=lambda x: (x[2], x[3], x[0]))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, str] | None = None,
                  least: float = LEAST) -> DataFrame:
    """One row per notice found: id, ``license``, ``coverage`` (share of its words aligned), ``start``, ``end`` (characters).

    Null, empty and clean texts give no row. Repeated rows give rows each.
    Finds of different notices may overlap (a short notice may begin a long
    one). Other columns are ignored.
    """
    split = {k: words(v)[0] for k, v in (NOTICES if notices is None else notices).items()}

    def make():
        def run(texts):
            return ([[{"license": n, "coverage": c, "start": s, "end": e} for n, c, s, e in scan(t, split, least)] for t in texts],)
        return run

    found = add_columns(docs.select(id_col, text_col), text_col, [id_col],
                        [("found", "array<struct<license:string,coverage:double,start:long,end:long>>")], make)
    return found.select(id_col, F.explode("found").alias("f")).select(id_col, "f.license", "f.coverage", "f.start", "f.end")
