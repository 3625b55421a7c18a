import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import divergence as V
from tests.llm.tables import clashing, documents, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MORE = [
    (900, "alpha beta alpha", "fr", "a", 1), (901, "alpha gamma alpha ÉCOLE École", "fr", "b", 1), (902, "alpha gamma", "fr", "b", 1),
    (903, "beta-gamma école ALPHA", "fr", "c", 1), (904, None, "fr", "d", 1), (905, "no term thrice", "xx", "a", 1), (906, "", "xx", "b", 1),
    (907, "alone", "solo", "s", 1), (908, "beta", None, "a", 1), (909, "gamma 1 2 3 \x00 école", "fr", "e", 1),
]


def words(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def slow(rows, min_docs=3, top=200):
    n, docs, groups = Counter(), Counter(), defaultdict(set)
    for _, text, lang, source, _ in rows:
        g = (lang or "", source or "")
        groups[g[0]].add(g[1])
        found = words(text)
        n.update((*g, w) for w in found)
        docs.update((g[0], w) for w in set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [w for (x, w), d in docs.items() if x == lang and d >= min_docs]
        v = len(kept)
        count = {s: {w: n[lang, s, w] for w in kept} for s in sources}
        whole = {w: sum(c[w] for c in count.values()) for w in kept}
        p = lambda c: {w: 1 + 10**9 * (x + 1) // (sum(c.values()) + v) for w, x in c.items()}  # noqa: B023, E731
        f = lambda a, b: (a - b) ** 2 // b
        shares, q = {s: p(c) for s, c in count.items()}, p(whole)
        for s in sources:
            pairs = [(-sum(f(shares[s][w], shares[o][w]) for w in kept), o.encode(), o) for o in sources - {s}]
            terms = [(-f(shares[s][w], q[w]), w.encode(), w) for w in kept if count[s][w] and shares[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(found, 1)}
    return out


NAMES = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("shard, block, top", [(200_000, 256, 200), (7, 2, 3), (1, 1, 200)])
def test_equals_brute_force(spark, shard, block, top):
    rows = documents() + MORE + MORE[:2]
    df = clashing(frame(spark, rows), ["part", "item", "value", "rank", "term", "n", "docs", "shard", "src"])
    got = V.audit(df, top=top, shard=shard, block=block)
    assert got.columns == NAMES
    assert Counter(tuple(r) for r in got.collect()) == Counter(slow(rows, top=top))


def test_empty_and_termless_tables(spark):
    assert V.audit(frame(spark, [])).count() == 0
    rows = [(1, "", "en", "a", 1), (2, None, "en", "b", 1), (None, "12 34", None, None, None)]
    assert {tuple(r) for r in V.audit(frame(spark, rows)).collect()} == slow(rows)


def test_shares_are_exact_for_large_counts():
    whole = 9_000_000_000_000_017
    got = V.shares(np.array([0, 5, whole // 3, whole - 1]), whole)
    assert got.tolist() == [1 + 10**9 * (c + 1) // whole for c in (0, 5, whole // 3, whole - 1)]


def test_partial_counts_are_bounded(spark, monkeypatch):
    """Small limits for the slices and held counts change nothing."""
    monkeypatch.setattr(V, "CHARS", 100)
    monkeypatch.setattr(V, "HELD", 10)
    rows = documents() + MORE
    assert {tuple(r) for r in V.audit(frame(spark, rows)).collect()} == slow(rows)
