import random
import re
from collections import Counter

import pytest

from millrace.llm import licenses as L
from tests.llm.tables import clashing, documents, frame, prose


def slow_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def slow_base(text):
    w = slow_words(text)
    places = [(k, label) for p, label in L.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


LICENSED = [
    (800, "Under the MIT License. under THE mit-license!", None, None, None), (801, "apache license version 2.0 and CC BY-NC", None, None, None),
    (802, "under the é mit license", None, None, None), (803, prose(random.Random(1), 90) + "\n" + L.BODIES["mit"] + " under the mit license", None, None, None),
    (804, "# " + L.BODIES["gpl-3"].replace(" ", "\n# ").upper(), None, None, None),
    (805, " ".join(L.BODIES["bsd-3"].split()[:20]), None, None, None),
]


def test_base_equals_brute_force_and_methods_labels_are_added(spark):
    rows = documents() + LICENSED
    got = L.scan(clashing(frame(spark, rows), ["labels", "SCORE"])).collect()
    base = lambda r: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
    assert Counter((r.doc_id, *base(r)) for r in got) == Counter((r[0], *slow_base(r[1])) for r in rows)
    by = {r.doc_id: r for r in got}
    assert by[803].labels == "mit" and by[803].score == 1.0 and by[803].spans[0].cover > 0.95
    assert by[804].labels == "gpl-3" and by[804].base_labels == "" and by[804].score > 0.95
    assert by[805].labels == "" and all(0 <= r.score <= 1 for r in got)
    assert L.scan(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics_equal_brute_force(seed):
    rng = random.Random(seed)
    sequences = [[rng.randrange(3 + seed) for _ in range(rng.randrange(1, 25))] for _ in range(4)]
    auto = L.Automaton(sequences)
    text = [rng.randrange(4 + seed) for _ in range(80)]
    places = {}
    for n, s in enumerate(sequences):
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                places.setdefault(tuple(s[a:b]), set()).add((n, b))
    for i, (state, matched) in enumerate(auto.statistics(text)):
        longest = max((k for k in range(i + 2) if k == 0 or tuple(text[i + 1 - k : i + 1]) in places))
        assert matched == longest
        if matched:
            assert set(auto.places[state]) == places[tuple(text[i + 1 - matched : i + 1])]
            assert len(auto.places[state]) == len(set(auto.places[state]))


def test_spans_survive_small_edits(spark):
    w = L.BODIES["apache-2"].split()
    w[10], w[30] = "changed", "also"
    rows = [(1, " ".join(w[:20] + ["added", "words"] + w[20:]), None, None, None)]
    found = L.scan(frame(spark, rows)).first()
    assert found.labels == "apache-2" and 0.8 < found.spans[0].cover < 1


LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
    "This work is licensed under the GNU General Public License, version 2.": "gpl-2",
    "THIS WORK is licensed\nunder the gnu general public license version 3": "gpl-3",
    "This work is licensed under the GNU General Public License.": "",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "bsd",
    "  GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007": "gpl-3",
    "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ terms and conditions for use, reproduction, and distribution": "apache-2",
    "this work is licensed by nobody under no general public rule": "",
}


@pytest.mark.parametrize("line", LINES)
def test_notices_and_headings(line):
    rng = random.Random(2)
    for text in (line, prose(rng, 40) + "\n" + line + "\n" + prose(rng, 40)):
        _, places, spans = L.Scanner().scan(text.encode())
        assert ",".join(sorted({s.label for s in spans})) == LINES[line]


def test_a_body_without_a_notice(spark):
    disclaimer = dict(L.PARTS)["mit"]
    rows = [(1, L.BODIES["mit"] + "\n\n" + disclaimer, None, None, None), (2, disclaimer, None, None, None), (3, dict(L.PARTS)["zlib"], None, None, None)]
    assert {r.doc_id: (r.base_labels, r.labels) for r in L.scan(frame(spark, rows)).collect()} == {1: ("", "mit"), 2: ("", "mit"), 3: ("", "zlib")}


def test_own_templates(spark):
    own = [L.Template("house", "only for the people of this house and their guests"), L.Template("line", "ask before you take it", 1.0)]
    rows = [(1, "x only for the people of this house y", None, None, None), (2, "ask before you take", None, None, None), (3, "please ask before you take it", None, None, None)]
    assert {r.doc_id: r.labels for r in L.scan(frame(spark, rows), templates=own, phrases={}).collect()} == {1: "house", 2: "", 3: "line"}


def best_chain(anchors, total, max_gap):
    """Most matched words of a chain that ends in each anchor, by trying all chains."""
    anchors = sorted(set(anchors))

    def ends_in(i):
        f, t, m = anchors[i]
        out = m
        for j in range(i):
            g, u, k = anchors[j]
            skip = max(0, g + k - f, u + k - t)
            if f - g <= total + max_gap and t > u and f > g and skip < m and max(f - g, t - u) - k <= max_gap:
                out = max(out, ends_in(j) + m - skip)
        return out

    return max((ends_in(i) for i in range(len(anchors))), default=0)


@pytest.mark.parametrize("seed", range(8))
def test_anchors_and_chains_equal_brute_force(seed):
    rng = random.Random(seed)
    template = [rng.choice("abcdefgh") for _ in range(24)]
    scanner = L.Scanner([L.Template("t", " ".join(template), 0.3)], {}, min_match=3, max_gap=4)
    text = list(template)
    for _ in range(rng.randrange(1, 7)):
        at = rng.randrange(len(text))
        text[at : at + rng.randrange(0, 3)] = [rng.choice("abcdefghz") for _ in range(rng.randrange(0, 4))]
    ids = [scanner.ids.get(w, -1) for w in text]
    found = {}
    at = 0
    while at < len(ids):  # runs of known words, as the scan cuts them
        stop = at
        while stop < len(ids) and ids[stop] >= 0:
            stop += 1
        if stop - at >= 3:
            scanner._anchors(ids[at:stop], at, found)
        at = stop + 1
    seq = scanner.sequences[0]
    longest = set()  # for each word, the longest run that ends there and occurs in the template, where the next word doesn't lengthen it
    def run(i):
        return max((m for m in range(i + 2) if m == 0 or any(ids[i + 1 - m : i + 1] == seq[t : t + m] for t in range(len(seq) - m + 1))), default=0)
    for i in range(len(ids)):
        m = run(i)
        if m >= 3 and (i + 1 == len(ids) or run(i + 1) <= m):
            longest |= {(i + 1 - m, t, m) for t in range(len(seq) - m + 1) if ids[i + 1 - m : i + 1] == seq[t : t + m]}
    assert set(found.get(0, [])) == longest
    spans = list(scanner._chains(0, found.get(0, [])))
    want = best_chain(found.get(0, []), len(seq), 4)
    assert max((s.matched for s in spans), default=0) == (want if want / len(seq) >= 0.3 else 0)
