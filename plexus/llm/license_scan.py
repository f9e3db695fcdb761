"""License notices in texts by patience alignment with templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_COVERAGE = 0.8
QUALIFIERS = frozenset("nc nd sa lesser library affero".split())  # words that make another license of one
_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]")

# The wording of notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                         "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                         "either express or implied.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                  "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
                      "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                      "distribute, sublicense, and/or sell copies of the Software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Rights reserved": "Copyright. All rights reserved",
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest increasing subsequence of the second numbers, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        if at == len(tops):
            tops.append(b)
            piles.append(k)
        else:
            tops[at], piles[at] = b, k
        back.append(piles[at - 1] if at else -1)
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal words in order: equal ends, then words unique to both sides as anchors, then the gaps between."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        places: dict[str, list[int]] = {}
        for k in range(a, b):
            places.setdefault(text[k], []).append(k)
        count: dict[str, int] = {}
        for k in range(c, d):
            count[template[k]] = count.get(template[k], 0) + 1
        unique = sorted((places[template[k]][0], k) for k in range(c, d)
                        if count[template[k]] == 1 and len(places.get(template[k], ())) == 1)
        anchors = _increasing(unique)
        if not anchors:
            continue
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        out += anchors
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
    return sorted(out)


def telling(name: str, template: list[str]) -> set[str]:
    """Words of the license's id (the name up to a blank) that its notice holds: a match must have them all."""
    return set(words_of(name.split()[0])) & set(template) if name.split() else set()


def find(text: list[str], template: list[str], min_coverage: float, needed: set[str] | frozenset[str] = frozenset()) -> list[tuple[float, int, int]]:
    """``(coverage, first, last)`` of every place where so much of a template stands in a text.

    A match lacks at most a share of the template's words, so it holds one of any larger number of
    them. Wide windows lie around the rarest ones in the text. Where copies stand close together their
    words are not unique there, so each place of one of the template's first words also begins a window
    that ends where that word begins the next copy, and one of just the template's length. Overlapping
    windows give the best. A match has all words of ``needed`` and no ``QUALIFIERS`` but the template's own.
    """
    n = len(template)
    at: dict[str, list[int]] = {w: [] for w in template}
    for k, w in enumerate(text):
        if w in at:
            at[w].append(k)
    lacking = int(n * (1 - min_coverage) + 1e-9)
    if sum(1 for w in template if not at[w]) > lacking:
        return []
    rare = sorted(range(n), key=lambda j: (len(at[template[j]]), j))[:lacking + 1]
    slack = n // 2 + 2
    windows = {(s, s + n + 2 * slack) for s in (max(0, p - j - slack) for j in rare for p in at[template[j]])}
    for j in range(min(lacking + 1, n)):
        places, again = at[template[j]], template[j:].count(template[j])
        for k, p in enumerate(places):
            after = places[k + again] - j if k + again < len(places) else len(text)
            windows.add((p, max(p + 1, min(after, p + n + slack))))
            windows.add((max(0, p - j), p - j + n))
    held = [0, *accumulate(w in at for w in text)]
    found: list[tuple[float, int, int]] = []
    for s, e in sorted(windows):
        if held[min(e, len(text))] - held[s] < min_coverage * n - 1e-9:
            continue
        pairs = align(text[s:e], template)
        if len(pairs) >= min_coverage * n - 1e-9 and pairs and needed <= {template[j] for _, j in pairs}:
            first, last = s + pairs[0][0], s + pairs[-1][0]
            if not any(w in QUALIFIERS and w not in at for w in text[first:last + 1]):
                found.append((len(pairs) / n, first, last))
    best: list[tuple[float, int, int]] = []
    # most of both sides paired: what a match lacks is not taken from the next copy
    for match in sorted(found, key=lambda m: (-m[0] / (n + m[2] - m[1] + 1), m[2] - m[1], m[1])):
        if all(match[2] < f or match[1] > l for _, f, l in best):
            best.append(match)
    return sorted(best, key=lambda m: m[1])


def _runs(text: str, overlap: int, size: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Words of a text in runs of bounded size, each with the last words of the one before, and the number of the first."""
    at, n, seen, tail = 0, len(text), 0, []
    while at < n:
        end = min(at + size, n)
        if end < n:
            gap = _GAP.search(text, end)
            end = gap.start() if gap else n
        run = tail + words_of(text[at:end])
        yield seen - len(tail), run
        seen += len(run) - len(tail)
        tail = run[-overlap:]
        at = end


def scan_text(text: str, templates: Mapping[str, list[str]], min_coverage: float = MIN_COVERAGE) -> list[tuple[str, float, int, int]]:
    out: set[tuple[str, float, int, int]] = set()
    overlap = 3 * max(map(len, templates.values()), default=0) + 8
    for base, run in _runs(text, overlap):
        have = set(run)
        for name, template in templates.items():
            if sum(w in have for w in template) >= min_coverage * len(template) - 1e-9:
                out.update((name, c, base + f, base + l) for c, f, l in find(run, template, min_coverage, telling(name, template)))
    kept: list[tuple[str, float, int, int]] = []
    for m in sorted(out, key=lambda m: (m[0], m[2], -m[1], m[3])):  # a match seen in two runs counts once
        if not kept or kept[-1][0] != m[0] or m[2] > kept[-1][3]:
            kept.append(m)
    # of notices of different wording in one place the one that fits best counts
    return [m for m in kept if not any(o[0] != m[0] and o[2] <= m[3] and m[2] <= o[3] and (o[1], o[3] - o[2]) > (m[1], m[3] - m[2]) for o in kept)]


def license_scan(docs: DataFrame, templates: Mapping[str, str] | None = None, key: str = "doc_id", text: str = "text",
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Op 9. ``key, license, coverage, first_word, last_word`` of each notice found, and its place in words.

    A template and a window of the text are aligned on words unique to both, the longest increasing
    subsequence of these anchors splits them into gaps, and the gaps are aligned in the same way. Coverage
    is the share of the template's words that have a partner. Words are letters and digits, lower-cased.
    A notice that comes twice is found twice, also back to back. The words of a license's id that stand in its
    notice must match, and words that make another license of it must not come in between. A map over whole texts without a shuffle; null and empty
    texts give no rows, repeated rows repeat theirs; templates are a parameter.
    """
    parsed = {name: words_of(t) for name, t in (TEMPLATES if templates is None else templates).items() if words_of(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for k, value in enumerate(batch.column(1)):
                for m in scan_text(value.as_py() or "", parsed, min_coverage):
                    at.append(k)
                    rows.append(m)
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                                              pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["k", "license", "coverage", "first_word", "last_word"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"k {dict(rows.dtypes)['k']}, license string, coverage double, first_word bigint, last_word bigint").withColumnRenamed("k", key)
