from collections import Counter

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash as S
from millrace.llm.common import components
from tests.llm.tables import DOCS, clashing, documents, frame, prose


def slow_fingerprint(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def slow_groups(rows):
    """Per row (id, fingerprint, least id it reaches), and the least id of every group."""
    fp = [slow_fingerprint(r[1] or "") for r in rows]
    v, label = np.array(fp, np.uint64), list(range(len(fp)))
    for a in range(len(fp)):
        for b in np.flatnonzero(np.bitwise_count(v ^ v[a]) <= 4):
            x, y = label[a], label[b]
            if x != y:
                label = [min(x, y) if z in (x, y) else z for z in label]
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[label[k]] = min(least.get(label[k], r[0]), r[0])
    return [(r[0], f, least.get(label[k])) for k, (r, f) in enumerate(zip(rows, fp))], [least.get(k) for k in sorted(set(label))]


def near(seed, n=120):
    """Near copies: a long text with few changes gives fingerprints some bits apart, in chains."""
    import random

    rng = random.Random(seed)
    text, rows = prose(rng, 300).split(), []
    for i in range(n):
        if i % 40 == 0:
            text = prose(rng, 300).split()
        text = list(text)
        text[rng.randrange(len(text))] = f"new{i}"
        rows.append((i, " ".join(text), None, None, None))
    return rows


@pytest.mark.parametrize("rows", [documents(), near(1), near(2)])
def test_groups_equal_brute_force(spark, rows):
    got = S.groups(frame(spark, rows).select("doc_id", "text")).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == Counter(slow_groups(rows)[0])


def test_large_buckets_are_cut_into_cells_without_loss(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL", 8)
    rows = near(3)
    got = S.groups(frame(spark, rows).select("doc_id", "text")).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == Counter(slow_groups(rows)[0])


def test_pivot_search_finds_every_close_pair():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for k in rng.integers(1, 6, 400)], np.uint64)
    fps = np.unique(np.concatenate([base, rng.choice(base, 400) ^ flips]))
    want = {(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if int(a ^ b).bit_count() <= 4}
    found = {tuple(sorted(p)) for a, b in S.cross_pairs(fps, fps, 4) for p in zip(a.tolist(), b.tolist()) if p[0] != p[1]}
    assert found == want
    runs = {(int(fps[x]), int(fps[y])) for i, j in S.runs_pairs(fps, np.full(len(fps), len(fps)), 4) for x, y in zip(i, j)}
    assert runs == want
    # the pivot table never drops a pair within the bound
    t = S.table(fps, S.pivots()).astype(int)
    place = {int(f): k for k, f in enumerate(fps)}
    assert all(np.abs(t[place[a]] - t[place[b]]).max() <= 4 for a, b in want)


def test_any_number_of_blocks_is_exact(spark):
    rows = near(4, 80)
    want = Counter(slow_groups(rows)[0])
    for blocks in (7, 8):
        got = S.groups(frame(spark, rows).select("doc_id", "text"), blocks=blocks).collect()
        assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want
    assert [S.blocks_for(n, 4) for n in (10, 10**9, 10**11, 10**13)] == [6, 6, 7, 8]


def test_busy_nodes_are_cut_by_their_children(spark, monkeypatch):
    """Stars far over the bound, chained, and nothing is copied that is not a busy node's parent."""
    from millrace.llm import common

    monkeypatch.setattr(common, "BUSY", 20)
    monkeypatch.setattr(common, "LINKS", 50)
    edges = [(hub, 1000 * hub + i) for hub in (1, 2, 3) for i in range(1, 150)] + [(1, 2), (2, 3), (7, 8)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 7 if n in (7, 8) else 1 for e in edges for n in e}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star + chain[:5], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = documents()
    df = clashing(frame(spark, rows), ["fp", "grp", "row"])
    kept = S.near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # one id a group; an id with two texts may name two groups; the null-id rows belong to groups that have ids
    want = sorted((c is None, c or 0) for c in slow_groups(rows)[1])
    assert got == want
    assert S.near_duplicates(frame(spark, [])).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f", None, None, None), (None, "a b c d e f", None, None, None), (None, "q r s t u v w", None, None, None)], DOCS)
    assert S.near_duplicates(nulls).count() == 2
