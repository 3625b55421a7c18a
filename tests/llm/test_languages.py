import itertools
import random
import zlib

import numpy as np
import pytest

from millrace.llm import languages as L
from tests.llm.tables import clashing, documents, frame

STEMS = {"aa": ["tion", "the", "ing", "and", "wh"], "bb": ["ungen", "sch", "lich", "der", "ü"], "cc": ["ción", "que", "los", "ado", "ñ"]}


def word(rng, lang):
    return "".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3)))


def text(rng, lang, n):
    return " ".join(word(rng, lang) + rng.choice(["", "", ",", ". 12"]) for _ in range(n))


def rows(n=240, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(STEMS))
        out.append((i, text(rng, lang, rng.randint(5, 60)), lang, "s", 1))
    return out


@pytest.fixture(scope="module")
def model():
    return L.fit([(t, lang) for i, t, lang, *_ in rows() if zlib.crc32(str(i).encode()) % 3 != 1])


def paths(scores, first, moves, start):
    """Marginals by enumeration of all label sequences."""
    n, k = scores.shape
    out = np.zeros((n, k))
    for tags in itertools.product(range(k), repeat=n):
        total = 0.0
        for t, y in enumerate(tags):
            total += scores[t, y] + (start[y] - np.log(np.exp(start).sum()) if first[t] else moves[tags[t - 1], y])
        for t, y in enumerate(tags):
            out[t, y] += np.exp(total)
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("n, k", [(1, 2), (2, 3), (7, 2), (8, 3)])
def test_marginals_equal_enumeration(n, k):
    rng = np.random.default_rng(n * k)
    scores, moves, start = rng.normal(0, 2, (n, k)), rng.normal(0, 2, (k, k)), rng.normal(0, 1, k)
    for cuts in ([], [n // 2], list(range(n))):
        first = np.zeros(n, bool)
        first[[0, *cuts]] = True
        assert np.allclose(L.marginals(scores, first, moves, start), paths(scores, first, moves, start))


def test_gradient_pieces_equal_enumeration():
    rng = np.random.default_rng(5)
    e, a, s = (np.exp(rng.normal(0, 1, shape)) for shape in ((1, 5, 3), (3, 3), 3))
    z, gamma, pairs = L._expected(e, a, s)
    total, want, moves = 0.0, np.zeros((5, 3)), np.zeros((3, 3))
    for tags in itertools.product(range(3), repeat=5):
        w = s[tags[0]] * np.prod([e[0, t, y] for t, y in enumerate(tags)]) * np.prod([a[x, y] for x, y in zip(tags, tags[1:])])
        total += w
        for t, y in enumerate(tags):
            want[t, y] += w
        for x, y in zip(tags, tags[1:]):
            moves[x, y] += w
    assert np.isclose(z, np.log(total)) and np.allclose(gamma[0], want / total) and np.allclose(pairs, moves / total)


def test_held_out_documents(spark):
    df = frame(spark, rows())
    got = {r.doc_id: r for r in L.identify(df, L.train(df)).collect()}
    held = [(r[2], got[r[0]]) for r in rows() if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([lang == g.lang_pred for lang, g in held]) > 0.97
    assert all(0 < g.score <= 1 for _, g in held) and np.mean([g.score for _, g in held]) > 0.9


def test_held_out_rows_are_not_learned_from(spark):
    odd = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s, n) for i, t, lang, s, n in rows(60)]
    assert sorted(L.sample(frame(spark, odd))) == sorted((t, lang) for i, t, lang, *_ in odd if lang != "zz")


def test_switches_inside_a_text(spark, model):
    rng = random.Random(9)
    parts = [("aa", 20), ("cc", 15), ("bb", 25)]
    mixed = " ".join(" ".join(word(rng, lang) for _ in range(n)) for lang, n in parts)
    got = L.identify(frame(spark, [(1, mixed, None, None, None)]), model, runs=True).first()
    tags = [x for r in got.runs for x in [r.lang] * r.n_words]
    want = [lang for lang, n in parts for _ in range(n)]
    assert np.mean([a == b for a, b in zip(tags, want)]) > 0.9 and got.lang_pred == "bb"
    assert got.n_labelled == 60 and got.n_switches == len(got.runs) - 1 and 0.3 < got.score < 0.6
    assert got.runs[0].first_word == 0 and all(a.first_word + a.n_words == b.first_word for a, b in zip(got.runs, got.runs[1:]))


def test_slices_and_cache_change_nothing(spark, model, monkeypatch):
    df = frame(spark, rows(60) + documents())
    key = lambda r: tuple((k, round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items())
    want = sorted(map(repr, map(key, L.identify(df, model).collect())))
    monkeypatch.setattr(L, "CHARS", 50)
    monkeypatch.setattr(L, "CACHE", 5)
    assert sorted(map(repr, map(key, L.identify(df, model).collect()))) == want


def test_awkward_rows(spark, model):
    extra = [(800, "12 34 -- !", "aa", None, 1), (801, None, "aa", None, 1), (802, "", None, None, 1), (803, "٣ ² ½", None, None, 1)]
    df = clashing(frame(spark, documents() + extra), ["lang_pred", "score", "n_labelled", "n_switches"])
    got = L.identify(df, model).collect()
    assert len(got) == len(documents() + extra)
    blank = [r for r in got if not any(c.isalpha() for c in r.text or "")]
    assert len(blank) >= 6 and {(r.lang_pred, r.score, r.n_labelled) for r in blank} == {("und", 0.0, 0)}
    assert {r.lang_pred for r in got if r not in blank} <= set(model.labels)
    assert L.identify(frame(spark, []), model).count() == 0


def test_few_labels(spark):
    none, one = L.train(frame(spark, [])), L.train(frame(spark, [(0, "only words", "xx", None, 1), (2, "more", None, None, 1)]))
    df = frame(spark, rows(5))
    assert {(r.lang_pred, r.score) for r in L.identify(df, none).collect()} == {("und", 0.0)}
    assert one.labels == ["xx"] and {(r.lang_pred, r.score) for r in L.identify(df, one).collect()} == {("xx", 1.0)}
