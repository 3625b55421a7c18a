from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import decontaminate as D
from tests.llm.tables import clashing, documents, frame, prose

ITEMS = "item_id long, text string"


def items(seed=2, n=30):
    import random

    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"q{i}x{k}" if k % 3 else rng.choice(["the", "of", "alpha", "beta"]) for k in range(rng.randrange(8, 70))]
        out.append((i, " ".join(words[:-4]) + ". " + " ".join(words[-4:]) + "."))
    return out + [(None, None), (n, ""), (n + 1, "Solo"), (3, out[3][1])]


def index(rows):
    texts = sorted({(i, t.encode()) for i, t in rows if t}, key=str)
    frequency, total = defaultdict(int), 0
    for _, t in texts:
        total += len(D.words(t))
        for w in set(D.words(t)):
            frequency[w] += 1
    return D.Index(texts, frequency, len(texts), total / len(texts))


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.9])
def test_retrieval_equals_scoring_every_part(threshold, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 64)
    ix = index(items())
    impact = defaultdict(dict)
    for t, p, x in zip(ix.term.tolist(), ix.part.tolist(), ix.impact.tolist()):
        impact[t][p] = x
    rng = np.random.default_rng(1)
    pairs, want = set(), {}
    for q in range(60):
        terms = set(rng.integers(1, len(ix.ids) + 1, 30).tolist()) if q % 2 else set(ix.term[ix.part == q % 30].tolist())
        score = defaultdict(float)
        for t in terms:
            pairs.add((q, t))
            for p, x in impact[t].items():
                score[p] += x
        want |= {(q, p): s for p, s in score.items() if s >= threshold}
    pairs = np.array(sorted(pairs))
    got = dict(zip(zip(*(x.tolist() for x in ix.retrieve(pairs[:, 0], pairs[:, 1], threshold)[:2])), ix.retrieve(pairs[:, 0], pairs[:, 1], threshold)[2].tolist()))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_leaks_are_found_wherever_they_stand_and_clean_texts_are_left(spark):
    import random

    rng, rows, want = random.Random(5), [], {}
    known = [r for r in items() if r[1]]
    for i in range(60):
        text = prose(rng, rng.randrange(0, 300)).split()
        if i % 3 == 0:
            item = known[i % len(known)]
            at = rng.randrange(len(text) + 1)
            held = item[1].upper().replace(".", " ;") if i % 2 else item[1]
            text[at:at] = held.split()
            want[i] = item[0]
        elif i % 3 == 1:
            item = known[i % 30]
            text[0:0] = item[1].split()[: len(item[1].split()) // 2]  # half a question, no answer
        rows.append((i, " ".join(text), None, None, None))
    benchmark = spark.createDataFrame(items(), ITEMS)
    got = {r.doc_id: {x.item_id for x in r.leaks} for r in D.leaks(frame(spark, rows), benchmark).collect() if r.leaks}
    assert got == {k: {v} for k, v in want.items()}
    clean = D.decontaminated(clashing(frame(spark, rows), ["leaks"]), benchmark)
    assert {r.doc_id for r in clean.collect()} == set(range(60)) - set(want) and "LEAKS" in clean.columns


def test_blocks_of_the_benchmark_give_the_same(spark):
    benchmark = spark.createDataFrame(items(), ITEMS)
    rows = [(i, t, None, None, None) for i, (_, t) in enumerate(items())]
    one = {r.doc_id: {(x.item_id, round(x.score, 9)) for x in r.leaks} for r in D.leaks(frame(spark, rows), benchmark).collect()}
    held = [ix.items for ix in D.indexes(benchmark, 3000)]
    assert len(held) > 1 and sum(map(len, held)) == len({r for r in items() if r[1]})
    old, D.indexes.__defaults__ = D.indexes.__defaults__, (3000,)
    try:
        many = {r.doc_id: {(x.item_id, round(x.score, 9)) for x in r.leaks} for r in D.leaks(frame(spark, rows), benchmark).collect()}
    finally:
        D.indexes.__defaults__ = old
    assert one == many


def test_awkward_rows_and_empty_tables(spark):
    benchmark = spark.createDataFrame(items(), ITEMS)
    df = frame(spark)
    assert D.leaks(df, benchmark).count() == len(documents())
    assert D.leaks(df, spark.createDataFrame([], ITEMS)).where("size(leaks) > 0").isEmpty()
    assert D.leaks(frame(spark, []), benchmark).count() == 0


def test_answer_is_the_last_sentence():
    assert D.answer_at(b"One two. Three four five.") == 2
    assert D.answer_at(b"One two three four five six seven eight") == 6
    assert D.answer_at(b"Solo") == 0
