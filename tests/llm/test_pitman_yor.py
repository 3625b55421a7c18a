import math
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import pitman_yor as P
from tests.llm.tables import documents, frame


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_base_and_counts_equal_brute_force(spark):
    rows = documents()
    got = P.score(frame(spark).repartition(3), bucket_bytes=4000).collect()
    assert len(got) == len(rows)
    train = Counter()
    for key, text, *_ in rows:
        if not P.held_out(key):
            train.update(tokens(text))
    total, distinct = sum(train.values()), len(train)
    want = Counter()
    for key, text, *_ in rows:
        w = tokens(text)
        base = sum(math.log10((train[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        want[key, P.held_out(key), len(w), sum(train[x] > 0 for x in w), total, round(base, 6)] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)


def test_held_out_is_the_contracts_fold():
    assert [P.held_out(i) for i in range(50)] == [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(50)]


def test_model_beats_word_counts_on_held_out_text(spark):
    """Text with a word order: the model's perplexity on held-out rows is below that of word counts."""
    rng = np.random.default_rng(3)
    follow = {w: rng.choice(60, 3) for w in range(60)}
    rows = []
    for i in range(300):
        w, text = int(rng.integers(60)), []
        for _ in range(30):
            text.append(f"w{w}")
            w = int(rng.choice(follow[w]))
        rows.append((i, " ".join(text), None, None, None))
    got = [r for r in P.score(frame(spark, rows), bucket_bytes=20_000).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.6 * sum(r.base_score for r in got)


def test_predictions_after_each_context_sum_to_one(spark):
    """One word "a" and the end. After an unseen word the parent's probabilities stand: P(a) + z + h = 1 for the end (z)
    and another unseen word (h); after "a", q + y + v = 1; after the start, x + e + u = 1. Seven texts give products of
    these; the first two sums then fix all of them, and the third must hold."""
    base = [(i, " ".join(["a"] * (1 + i % 4)), None, None, None) for i in range(60) if not P.held_out(i)]
    probes = ["", "new", "new new", "new a", "new a a", "new a new", "a"]
    keys = [i for i in range(1000, 4000) if P.held_out(i)][: len(probes)]
    rows = base + [(k, t, None, None, None) for k, t in zip(keys, probes)]
    score = {r.doc_id: 10**r.score for r in P.score(frame(spark, rows)).collect()}
    end, new, new_new, new_a, new_a_a, new_a_new, a = (score[k] for k in keys)
    h, q = new_new / new, new_a_a / new_a
    rest = new * (1 - q)
    z = (1 - h - new_a_new / rest) / (1 + new_a / rest)
    y = (1 - q) * z * new_a / (z * new_a + new_a_new)
    assert math.isclose(a / y + end + new / z, 1, rel_tol=1e-4)


def exact_tables(c, prior, discount, strength):
    """Distribution of the number of tables of one dish of ``c`` customers alone in its restaurant."""
    states = {((1,), 1): 1.0}
    for n in range(1, c):
        after = Counter()
        for (sizes, t), p in states.items():
            after[tuple(sorted((*sizes, 1))), t + 1] += p * (strength + discount * t) * prior
            for k, s in enumerate(sizes):
                grown = tuple(sorted((*sizes[:k], s + 1, *sizes[k + 1 :])))
                after[grown, t] += p * (s - discount)
        states = after
    total = sum(states.values())
    out = Counter()
    for (_, t), p in states.items():
        out[t] += p / total
    return out


@pytest.mark.parametrize("c,prior", [(2, 0.5), (5, 0.3), (6, 0.9)])
def test_gibbs_seatings_have_the_exact_distribution(c, prior):
    n, rng = 20_000, np.random.default_rng(5)
    context = np.arange(n)
    got = P.seat(np.full(n, c), np.full(n, prior), context, np.ones(n), 0.4, 1.0, 40, rng, False)
    want = exact_tables(c, prior, 0.4, 1.0)
    for t, p in want.items():
        assert abs((got == t).mean() - p) < 0.02, (t, p)


def test_tables_stay_between_one_and_all_customers():
    rng = np.random.default_rng(1)
    c = rng.integers(2, 5000, 500)
    t = P.seat(c, rng.random(500), rng.integers(0, 40, 500), np.full(40, 13.0), 0.6, 1.0, 8, rng, False)
    assert (t >= 1).all() and (t <= c).all()


def test_empty_tables(spark):
    assert P.score(frame(spark, [])).count() == 0
    alone = P.score(frame(spark, [(6, None, None, None, None)])).collect()
    assert [(r.n_tokens, r.held_out) for r in alone] == [(1, P.held_out(6))]


def stirling(c, top, discount):
    """log S(c, 1..top) by the recursion over customers."""
    t = np.arange(1, top + 1)
    row = np.where(t == 1, 0.0, -np.inf)
    for n in range(1, c):
        with np.errstate(invalid="ignore", divide="ignore"):
            stay = np.where(t <= n, row + np.log(np.maximum(n - discount * t, 1e-300)), -np.inf)
        row = np.logaddexp(stay, np.concatenate([[-np.inf], row[:-1]]))
    return row


@pytest.mark.parametrize("c,rate,mean", [(50, 1.0, 2.3), (1000, 1.0, 2.3), (1000, 10.0, 13.6), (5000, 5.0, 7.3), (5000, 900.0, None)])
def test_one_sweep_draws_frequent_dishes_from_the_exact_law(c, rate, mean):
    n, top, rng = 3000, min(c, 2000), np.random.default_rng(2)
    got = P.seat(np.full(n, c), np.full(n, 0.1), np.zeros(n, np.int64), None, 0.8, P.STRENGTH, 1, rng, True, gamma=np.array([rate / 0.08]))
    t = np.arange(1, top + 1)
    law = stirling(c, top, 0.8) + t * math.log(rate)
    law = np.exp(law - law.max())
    law /= law.sum()
    exact, sd = (law * t).sum(), math.sqrt((law * t * t).sum() - (law * t).sum() ** 2)
    assert mean is None or abs(exact - mean) < 0.1
    assert abs(got.mean() - exact) < 4 * sd / math.sqrt(n)
    below = np.cumsum(law)[got.clip(1, top) - 1]
    for q in (0.25, 0.5, 0.75):
        k = int(np.searchsorted(np.cumsum(law), q))
        assert abs((got <= k + 1).mean() - np.cumsum(law)[k]) < 0.04
    assert below.min() > 0


def test_production_sweeps_reach_the_law_of_a_frequent_dish_alone():
    """1000 customers, by the first sample: p(t) ~ S(c, t) prior^t (s + d) ... (s + (t - 1) d)."""
    n, c, d, prior, rng = 4000, 1000, 0.8, 0.2, np.random.default_rng(8)
    got = P.seat(np.full(n, c), np.full(n, prior), np.arange(n), np.ones(n), d, P.STRENGTH, P.BURN_IN + 1, rng, False)
    t = np.arange(1, c + 1)
    law = stirling(c, c, d) + t * math.log(prior) + np.concatenate([[0], np.cumsum(np.log(P.STRENGTH + d * t[:-1]))])
    law = np.exp(law - law.max())
    law /= law.sum()
    assert abs(got.mean() - (law * t).sum()) < 0.1
    for k in (1, 2, 3):
        assert abs((got == k).mean() - law[k - 1]) < 0.03


def test_numbers_beyond_the_recursion_are_those_of_the_recursion():
    for d in (0.1, 0.5, 0.8, 0.95):
        t = np.unique(np.geomspace(1, 900, 60).astype(int))
        assert np.abs(P.log_stirling(1000, t, d) - stirling(1000, 1000, d)[t - 1]).max() < 1e-6


def test_all_frequent_dishes_are_evaluated_together(monkeypatch):
    """300 dishes of different counts beyond the recursion: a few calls for all, not several for each."""
    calls, whole = [], P.log_coefficient
    monkeypatch.setattr(P, "log_coefficient", lambda *a: calls.append(1) or whole(*a))
    c = np.arange(2000, 2300)
    got = P.draw_tables(c, np.full(300, 2.0), 0.75, np.random.default_rng(4))
    assert len(calls) <= 10
    assert (got >= 1).all() and 1 < got.mean() < 6


@pytest.mark.parametrize("d", [0.1, 0.5, 0.8])
def test_numbers_of_several_counts_at_once_are_those_of_each(d):
    t = np.arange(1, 60)
    both = P.log_coefficient(np.repeat([1200, 5000], 59), np.tile(t, 2), d)
    assert np.allclose(both, np.concatenate([P.log_coefficient(c, t, d) for c in (1200, 5000)]))


@pytest.mark.parametrize("d", [0.1, 0.5, 0.8, 0.95])
def test_weight_outside_the_evaluated_numbers_is_nil(d):
    c, t = 1500, np.arange(1, 1501)
    for rate in (1e-9, 0.05, 2.0, 300.0, 1e5):
        law = P.log_coefficient(c, t, d) - P.log_factorial(t) - t * math.log(d) + t * math.log(rate)
        low, high = (int(x[0]) for x in P.weighty(np.array([c]), *[np.log([rate])] * 2, d))
        out = law[(t < low) | (t > high)]
        assert not len(out) or out.max() < law.max() - 40


@pytest.mark.parametrize("values", [[], [0.0], [0.2, 0.2, 5.0], list(range(400)) + [3] * 9])
def test_coded_values_come_back(values):
    values = np.array(values, np.float32)
    common, code, _ = P.coded(values)
    assert (P.uncoded(common, code, values[code == 255]) == values).all()


def test_texts_are_cut_once_and_kept_beside_the_questions(spark, tmp_path):
    """The questions' stage leaves one file a chunk, which the scores are made from."""
    folder = tmp_path / "texts"
    folder.mkdir()
    docs = frame(spark).select("doc_id", "text").repartition(3)
    asked = docs.mapInArrow(P.asker(4, np.zeros(0, np.uint64), str(folder)), P.MESSAGE).collect()
    names = {P.unpack(r.blob)[8] for r in asked}
    assert len(names) == 3 and names == {f.name for f in folder.iterdir()}
    keys = [k for f in folder.iterdir() for k in P.unpack(f.read_bytes())[0]]
    assert Counter(keys) == Counter(r.doc_id for r in docs.collect())
