import random

import numpy as np
import pytest

from millrace.llm import toxicity as X
from tests.llm.tables import clashing, documents, frame, prose

LABELS = "doc_id long, quality int, toxic int"
BAD = ["villain", "rotten", "filthy", "vermin"]


def labelled(n=600, seed=4):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = prose(rng, rng.randrange(30, 200)).split()
        for _ in range(max(3, len(words) // 25) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled()
    model = X.train(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r for r in X.score(frame(spark, rows), model).collect()}
    held = [(labels[i][2], got[i].predicted, got[i].score) for i in got if X.zstandard and __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    toxic, plain = [p for y, p, _ in held if y], [p for y, p, _ in held if not y]
    assert np.mean(toxic) > 0.9 and np.mean(plain) < 0.03
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, p, s in held)


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark):
    import zlib

    rows, labels = labelled(120)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a, b = (X.train(frame(spark, rows), spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a == b


def test_remove_toxic_keeps_columns(spark):
    rows, labels = labelled(300)
    df = clashing(frame(spark, rows + documents()[-8:]), ["score", "predicted"])
    kept = X.remove_toxic(df, spark.createDataFrame(labels, LABELS), frame(spark, rows))
    assert kept.columns == df.columns and len(rows) * 0.7 < kept.count() < len(rows) * 0.9 + 8


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, None, None), (None, 1, 1)], [(0, 1, 0), (2, 1, 1), (2, 1, 0)]])
def test_too_few_labels_give_a_constant_score(spark, labels):
    model = X.train(frame(spark), spark.createDataFrame(labels, LABELS))
    got = X.score(frame(spark), model).collect()
    assert len(got) == len(documents()) and len({r.score for r in got}) == 1


def test_empty_texts_and_tables(spark):
    rows, labels = labelled(200)
    model = X.train(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    got = X.score(frame(spark), model).collect()
    blank = {r.score for r in got if not (r.text or "").strip()}
    assert len(got) == len(documents()) and len(blank) == 1 and max(blank) < 0.5
    assert X.score(frame(spark, []), model).count() == 0
