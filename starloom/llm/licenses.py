"""License scan by patience alignment against notice templates.

A notice is a stretch of at most twice a template's length. A document is read as words in
windows of three times that length, laid at every template length, so each such stretch lies
whole in one window, whatever its place. A window is aligned with the template: words that occur exactly once in both are anchors, the longest increasing
subsequence of the anchors fixes the frame, and the gaps between anchors (after cutting equal
ends) are aligned the same way. Coverage is the share of template words that are aligned; a
notice is found where coverage reaches the threshold.

Words beside a notice may repeat its words and so take anchors away; where a window that holds
enough template words does not reach the threshold, the stretches in it are aligned on their
own at every place. A window or stretch that holds fewer template words, each counted as often
as the template has it, than the threshold asks for cannot reach it and is not aligned. Whole texts are read; the window bounds the work of an alignment, not the text.

Defined results: null and empty texts hold no notice; every place of a notice is found, also
of the same one; of notices at overlapping places the best covered one counts, then the one
with more words, then the tighter and the earlier one, and the words beside it are aligned
again; templates without words are ignored; repeated rows get equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import pick

COVERAGE = 0.8

#: Notices and short license texts of public licenses (name, text).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at"""),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files, to deal in the Software without restriction"""),
    ("MIT-full", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-header", """This program is free software; you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation; either version 2 of the License,
        or (at your option) any later version."""),
    ("GPL-3.0-header", """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version."""),
    ("LGPL-2.1-header", """This library is free software; you can redistribute it and/or modify it under the terms of
        the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
        License, or (at your option) any later version."""),
    ("AGPL-3.0-header", """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the
        License, or (at your option) any later version."""),
    ("MPL-2.0-header", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at"""),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met"""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the
        names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("CC0-1.0", """To the extent possible under law, the author has waived all copyright and related or neighboring
        rights to this work."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
]

_word = re.compile(r"[^\W_]+")


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions (i, j) of aligned equal words of two sequences, increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at_b]
        chain = _rising(anchors)
        if not chain:
            continue
        out.extend(chain)
        before = (a0 - 1, b0 - 1)
        for here in [*chain, (a1, b1)]:
            work.append((before[0] + 1, here[0], before[1] + 1, here[1]))
            before = here
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (sorted by the first) whose second part rises."""
    ends: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        n = bisect_left(ends, j)
        back.append(at[n - 1] if n else -1)
        if n == len(ends):
            ends.append(j)
            at.append(k)
        else:
            ends[n], at[n] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


class Scanner:
    """Templates as word numbers; 0 is every word that no template has."""

    def __init__(self, templates: list[tuple[str, str]], coverage: float):
        self.coverage = coverage
        self.number: dict[str, int] = {}
        self.templates: list[tuple[str, list[int]]] = []
        for name, text in templates:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in _word.findall(text.lower())]
            if words:
                self.templates.append((name, words))
        #: Whether a template has a word number, and how often.
        self.has = np.zeros((len(self.templates), len(self.number) + 1), bool)
        for t, (_, words) in enumerate(self.templates):
            self.has[t, words] = True
        self.often = [Counter(words) for _, words in self.templates]

    def find(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """Of ``places``, the best covered and then first one of each template."""
        best: dict[str, tuple[str, float, int, int]] = {}
        for f in self.places(text):
            if f[0] not in best or f[1] > best[f[0]][1]:
                best[f[0]] = f
        return list(best.values())

    def places(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, start, stop) of every notice in a text, in code points, in
        template order and then by place."""
        if not text:
            return []
        lower = text.lower()
        get = self.number.get
        words = [get(w, 0) for w in _word.findall(lower)]
        ids = np.array(words, np.int32)
        if not ids.any():
            return []
        places = self._places(words, ids)
        if not places:
            return []
        # Lower-casing may change lengths, so places come from the text itself.
        spans = [m.span() for m in _word.finditer(text)]
        if len(spans) != len(words):
            spans = [m.span() for m in _word.finditer(lower)]
        return [(self.templates[t][0], share, spans[a][0], spans[b - 1][1])
                for t, share, a, b in sorted(places, key=lambda f: (f[0], f[2]))]

    def _places(self, words: list[int], ids: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(template, coverage, start, stop) of all notices, in words. Rounds: of what aligns
        with the highest coverage, the best at each place stays; pieces that it touches are cut
        to what is left free of them and aligned again."""
        work: list[tuple[int, int, int]] = []
        held: list[np.ndarray] = []
        for t, (_, template) in enumerate(self.templates):
            n = len(template)
            held.append(np.zeros(len(ids) + 1, np.int32))
            np.cumsum(self.has[t, ids], out=held[t][1:])
            if held[t][-1] < self.coverage * n:
                continue
            starts = np.arange(0, len(ids), n)
            stops = np.minimum(starts + 3 * n, len(ids))
            enough = held[t][stops] - held[t][starts] >= self.coverage * n
            work.extend((t, lo, hi) for lo, hi in zip(starts[enough].tolist(), stops[enough].tolist(), strict=True)
                        if self._may(t, words, lo, hi))
        kept: list[tuple[int, float, int, int]] = []
        hits: dict[tuple[int, int, int], tuple[int, float, int, int]] = {}
        while True:
            for t, lo, hi in work:
                share, start, stop = self._tight(t, words, lo, hi)
                hits[t, lo, hi] = (t, share if share >= self.coverage else 0.0, start, stop)
            top = max((f[1] for f in hits.values()), default=0.0)
            if not top:
                return kept
            new = self._best_at_each_place({f for f in hits.values() if f[1] == top})
            kept.extend(new)
            begins, ends = [f[2] for f in new], [f[3] for f in new]
            left: set[tuple[int, int, int]] = set()
            for t, lo, hi in list(hits):
                i, at = bisect_left(ends, lo + 1), lo
                if i == len(new) or begins[i] >= hi:
                    continue
                del hits[t, lo, hi]
                while i < len(new) and begins[i] < hi:
                    left.add((t, at, begins[i]))
                    at = ends[i]
                    i += 1
                left.add((t, at, hi))
            work = [(t, lo, hi) for t, lo, hi in left
                    if lo < hi and held[t][hi] - held[t][lo] >= self.coverage * len(self.templates[t][1])
                    and self._may(t, words, lo, hi)]

    def _may(self, t: int, words: list[int], lo: int, hi: int) -> bool:
        """Whether enough words of a template are there, in whatever order."""
        have, often = Counter(words[lo:hi]), self.often[t]
        return sum(min(k, have[w]) for w, k in often.items()) >= self.coverage * len(self.templates[t][1])

    def _stretches(self, t: int, words: list[int], lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Stretches of a window that may hold a notice, at every place."""
        often, n = self.often[t], len(self.templates[t][1])
        for size in (2 * n, n + n // 4):
            if size >= hi - lo:
                continue
            have: Counter[int] = Counter()
            shared = 0
            for i in range(lo, hi):
                w = words[i]
                have[w] += 1
                shared += have[w] <= often.get(w, 0)
                if i - size >= lo:
                    w = words[i - size]
                    shared -= have[w] <= often.get(w, 0)
                    have[w] -= 1
                if i - lo >= size - 1 and shared >= self.coverage * n:
                    yield i + 1 - size, i + 1

    def _tight(self, t: int, words: list[int], lo: int, hi: int) -> tuple[float, int, int]:
        """(coverage, start, stop) of a template between two words. An alignment may begin in
        one notice and end in another, so its two ends are tried on their own."""
        template = self.templates[t][1]
        n = len(template)

        def aligned(lo: int, hi: int) -> tuple[float, int, int]:
            got = align(template, words[lo:hi])
            return (len(got) / n, lo + got[0][1], lo + got[-1][1] + 1) if got else (0.0, lo, lo)

        best = aligned(lo, hi)
        if best[0] < self.coverage:
            for x, y in self._stretches(t, words, lo, hi):
                best = max(best, aligned(x, y), key=lambda e: e[0])
        while best[0] >= self.coverage and best[2] - best[1] > n:
            _, a, b = best
            ends = [aligned(x, y) for m in (n, n + n // 4) if m < b - a for x, y in ((a, a + m), (b - m, b))]
            closer = [e for e in ends if e[0] >= best[0] and e[2] - e[1] < b - a]
            if not closer:
                break
            best = min(closer, key=lambda e: (-e[0], e[2] - e[1], e[1]))
        return best

    def _best_at_each_place(self, found: set[tuple[int, float, int, int]]) -> list[tuple[int, float, int, int]]:
        """Of notices that overlap, the one with the higher coverage, then with more words, then
        the tighter and the earlier one; by place."""
        begins: list[int] = []
        kept: list[tuple[int, float, int, int]] = []
        for f in sorted(found, key=lambda f: (-f[1], -len(self.templates[f[0]][1]), f[3] - f[2], f[2], f[0])):
            i = bisect_left(begins, f[2])
            if (i == 0 or kept[i - 1][3] <= f[2]) and (i == len(kept) or f[3] <= kept[i][2]):
                begins.insert(i, f[2])
                kept.insert(i, f)
        return kept


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id",
         text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """(id, found) for every row; found is an array of (template, coverage, start, stop) in
    template order and then by place, places in code points. The template list is a parameter that every task
    gets, of the size the caller gives it."""
    given = TEMPLATES if templates is None else templates
    base = pick(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, coverage)
        kind = pa.list_(pa.struct([("template", pa.string()), ("coverage", pa.float64()),
                                   ("start", pa.int32()), ("stop", pa.int32())]))
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                s = b.slice(lo, 500)
                found = [[{"template": t, "coverage": c, "start": x, "stop": y}
                          for t, c, x, y in scanner.places(text)] for text in s.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([s.column("id"), pa.array(found, kind)], names=["id", "found"])

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(
        work, f"id {kind}, found array<struct<template:string,coverage:double,start:int,stop:int>>").select(
        F.col("id").alias(id_col), "found")
