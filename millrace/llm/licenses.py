"""Licence scan: a generalised suffix automaton of licence texts gives matching statistics of every file; long matches
are chained into covered template spans.

The automaton holds all templates' tokens. A file is streamed through it word by word: at each word it knows the longest
run ending there that occurs in some template. Maximal runs of at least ``MIN_MATCH`` words are anchors; per template,
anchors in the same order in file and template, with gaps of at most ``MAX_GAP`` words, are chained for the most
matched words. A chain that covers enough of its template (``MIN_COVER`` of a body, all of a one-line notice) is a span
and labels the file. A licence may have several templates: its body, its disclaimer, the heading of its whole text, the
notices that files carry.

Short marker phrases label a file wherever their words stand consecutively. Null, empty and wordless texts have no words,
no places and score 0; repeated rows are scanned alike. Columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fields, raw

MIN_MATCH, MAX_GAP, MIN_COVER = 4, 12, 0.6

#: Marker phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

@dataclass(frozen=True)
class Template:
    """Text that stands for a licence. A file holds it if a chain covers ``cover`` of its words; a licence may have several."""

    label: str
    text: str
    cover: float = MIN_COVER


#: Public licence texts, or the notices that files carry in their place, by label.
BODIES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-3": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.",
}

#: Further parts of public licence texts: disclaimers, headings that open a whole text, other licences.
PARTS = [
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
     "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
     "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("apache-2", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
     "AND DISTRIBUTION"),
    ("gpl-3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("gpl-2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("lgpl-3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("agpl-3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("mpl-2", "Mozilla Public License Version 2.0"),
    ("boost-1", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
     "transmit the Software"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
     "for any damages arising from the use of this software."),
]

#: One-line notices. All their words must be there, since a version number may tell two licences apart.
NOTICES = [
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3", "licensed under the GNU General Public License v3"),
    ("gpl-2", "licensed under the GNU General Public License v2"),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("mpl-2", "licensed under the Mozilla Public License, version 2.0"),
    ("mit", "licensed under the MIT License"),
    ("isc", "licensed under the ISC License"),
    ("unlicense", "released into the public domain"),
]
HEADING = 16  # texts of so few words count whole only

TEMPLATES = (
    *(Template(label, text) for label, text in BODIES.items()),
    *(Template(label, text, 1.0 if len(text.split()) <= HEADING else MIN_COVER) for label, text in PARTS),
    *(Template(label, text, 1.0) for label, text in NOTICES),
)

#: A-Z to a-z; every other ASCII byte that is no digit or letter to a space. Bytes from 0x80 on belong to words.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() and b < 0x80 else 0x20 for b in range(256)).lower()


def words(text: bytes) -> list[bytes]:
    """Words of letters a-z, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several token sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[tuple[int, int, int]] = []  # (state, sequence, end)
        for n, seq in enumerate(sequences):
            last = 0
            for end, t in enumerate(seq, 1):
                last = self._extend(last, t)
                own.append((last, n, end))
        #: For each state the (sequence, end) places of its longest string.
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.go]
        for state, n, end in own:
            while state > 0:
                if (n, end) in self.places[state][-1:]:
                    break
                self.places[state].append((n, end))
                state = self.link[state]

    def _add(self, length: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        return len(self.go) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        """A state of length ``length[p] + 1`` for ``t`` after ``p``, split off ``q``."""
        clone = self._add(self.length[p] + 1, dict(self.go[q]), self.link[q])
        while p >= 0 and self.go[p].get(t) == q:
            self.go[p][t] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, t: int) -> int:
        q = self.go[last].get(t)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, t)
        new, p = self._add(self.length[last] + 1, {}, 0), last
        while p >= 0 and t not in self.go[p]:
            self.go[p][t] = new
            p = self.link[p]
        if p >= 0:
            q = self.go[p][t]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, t)
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """For each token, (state, length) of the longest run ending there that occurs in a sequence."""
        go, link, length = self.go, self.link, self.length
        state = matched = 0
        for t in tokens:
            while state and t not in go[state]:
                state = link[state]
                matched = length[state]
            if t in go[state]:
                state = go[state][t]
                matched += 1
            yield state, matched


@dataclass(frozen=True)
class Span:
    """A covered template span: file words ``start`` to ``end`` (exclusive) match ``matched`` words of the template."""

    label: str
    start: int
    end: int
    matched: int
    cover: float


class Scanner:
    """Scans one file's words at a time."""

    def __init__(self, templates: Sequence[Template] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                 min_match: int = MIN_MATCH, max_gap: int = MAX_GAP):
        self.templates = list(templates)
        texts = [words(t.text.encode()) for t in self.templates]
        marks = [words(p.encode()) for p in phrases]
        self.ids = {w: i for i, w in enumerate(sorted({w for t in texts + marks for w in t}))}
        self.sequences = [[self.ids[w] for w in t] for t in texts]
        self.phrases = [([self.ids[w] for w in m], label) for m, label in zip(marks, phrases.values())]
        self.automaton = Automaton(self.sequences)
        self.min_match, self.max_gap = min_match, max_gap

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, str]], list[Span]]:
        """Number of words, the places of phrases (start, label), the spans."""
        w = words(text)
        ids = np.fromiter(map(self.ids.get, w, repeat(-1)), np.int32, len(w))
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return len(w), [], []
        cuts = np.flatnonzero(np.diff(known) > 1) + 1
        starts, stops = known[np.concatenate([[0], cuts])], known[np.concatenate([cuts - 1, [len(known) - 1]])] + 1
        places = []
        for seq, label in self.phrases:
            if len(ids) >= len(seq):
                hit = np.ones(len(ids) - len(seq) + 1, bool)
                for k, t in enumerate(seq):
                    hit &= ids[k : len(ids) - len(seq) + 1 + k] == t
                places += [(int(p), label) for p in np.flatnonzero(hit)]
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in zip(starts.tolist(), stops.tolist()):
            if b - a >= self.min_match:
                self._anchors(ids[a:b].tolist(), a, anchors)
        spans = [s for n, found in anchors.items() for s in self._chains(n, found)]
        return len(w), sorted(places), sorted(spans, key=lambda s: (s.start, s.label, s.end))

    def _anchors(self, tokens: list[int], at: int, out: dict[int, list[tuple[int, int, int]]]) -> None:
        """Maximal runs (file start, template start, length): those that the next word does not lengthen."""
        stats = list(self.automaton.statistics(tokens))
        for i, (state, matched) in enumerate(stats):
            if matched >= self.min_match and (i + 1 == len(stats) or stats[i + 1][1] <= matched):
                for n, end in self.automaton.places[state]:
                    out.setdefault(n, []).append((at + i + 1 - matched, end - matched, matched))

    def _chains(self, n: int, anchors: list[tuple[int, int, int]]) -> Iterator[Span]:
        """Best chains of one template's anchors, taken greedily without sharing file words."""
        anchors = sorted(set(anchors))
        best, back = [a[2] for a in anchors], [-1] * len(anchors)
        total = len(self.sequences[n])
        for i, (f, t, m) in enumerate(anchors):
            for j in range(i - 1, -1, -1):
                g, u, k = anchors[j]
                if f - g > total + self.max_gap:
                    break
                skip = max(0, g + k - f, u + k - t)  # words that both anchors would count
                if t > u and f > g and skip < m and max(f - g, t - u) - k <= self.max_gap and best[j] + m - skip > best[i]:
                    best[i], back[i] = best[j] + m - skip, j
        used: set[int] = set()
        for i in sorted(range(len(anchors)), key=lambda i: (-best[i], i)):
            chain, j = [], i
            while j >= 0:
                chain.append(j)
                j = back[j]
            if used.isdisjoint(chain):
                used.update(chain)
                cover = min(1.0, best[i] / total)
                if cover >= self.templates[n].cover:
                    yield Span(self.templates[n].label, anchors[chain[-1]][0], anchors[i][0] + anchors[i][2], best[i], cover)


def scan(files: DataFrame, text: str = "text", hide: tuple[str, ...] = (), templates: Sequence[Template] = TEMPLATES,
         phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Add n_words, n_base (places of phrases), first_word and last_word (their least and largest start, else null),
    base_labels and labels (distinct, sorted, comma-joined), score (1 with a phrase, else the best span's cover, else 0)
    and spans (array of label, start, end, matched words, cover) to every row. ``templates`` and ``phrases`` may be one's
    own."""
    at = files.columns.index(text)
    span = "array<struct<label:string,start:bigint,end:bigint,matched:bigint,cover:double>>"
    added = fields(
        n_words="long", n_base="long", first_word="long", last_word="long", base_labels="string", labels="string", score="double", spans=span
    )

    def run(batches):
        scanner = Scanner(templates, phrases)
        for b in batches:
            rows = []
            for t in raw(b.column(at)):
                n, places, spans = scanner.scan(t)
                base = sorted({label for _, label in places})
                every = sorted({*base, *(s.label for s in spans)})
                score = 1.0 if places else max((s.cover for s in spans), default=0.0)
                held = [dict(label=s.label, start=s.start, end=s.end, matched=s.matched, cover=s.cover) for s in spans]
                ends = (places[0][0], places[-1][0]) if places else (None, None)
                rows.append((n, len(places), *ends, ",".join(base), ",".join(every), score, held))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            kinds.append(pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("cover", pa.float64())])))
            yield [pa.array([r[k] for r in rows], kinds[k]) for k in range(8)]

    return arrow_map(files.withColumn(text, F.col(text).cast("string")), run, added, hide)
