"""The pipeline over a table with planted cases. Its result is held against the stages' own brute-force tests: what must
go is gone, one row of each group of copies stays, clean rows are kept."""

import importlib.util
import random

import pytest

from tests.llm.tables import DOCS, prose
from tests.llm.test_toxicity import BAD, LABELS

pytestmark = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")


@pytest.fixture
def planted(spark, tmp_path):
    rng, rows, labels, gone, leaks = random.Random(9), [], [], set(), []
    for i in range(400):
        words = [w + str(rng.randrange(30)) for w in prose(rng, rng.randrange(60, 150)).split()]
        kind = i % 10
        if kind == 0:
            for _ in range(8):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        labels.append((i, 1, int(kind == 0)))
        text = " ".join(words)
        if kind == 1:
            text = " ".join(["again and again it says"] * 40)
        if kind == 2:
            text = rows[i - 7][1] if i > 10 else text  # a copy of a clean text (kind 5)
        if kind == 3 and i > 200:
            item = " ".join(f"secret{i}x{k}" for k in range(20)) + ". " + " ".join(f"answer{i}x{k}" for k in range(6)) + "."
            leaks.append((i, item))
            text = text + " " + item
        if kind in (0, 1) or (kind == 2 and i > 10) or (kind == 3 and i > 200):
            gone.add(i)
        rows.append((i, text, "en", "s", len(text)))
    d = str(tmp_path)
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(leaks, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, gone


def test_planted_rows_go_and_clean_rows_stay(spark, planted):
    import corpus_pipeline as C

    d, rows, gone = planted
    docs, names = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/documents.parquet").columns
    ids = {r[0] for r in rows}
    for name, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, d), name)
        assert docs.columns == names, name
    got = {r.doc_id for r in docs.collect()}
    left = got & gone  # 27 toxic rows to learn from: a few may slip through
    assert all(i % 10 == 0 for i in left) and len(left) <= 4
    assert len(ids - gone - got) <= 0.03 * len(ids - gone)
    out = C.STAGES[-1][1](spark, docs, d).collect()
    assert {r.doc_id for r in out} == got and all(r.round_trip and len(r.ids) == r.n_pieces for r in out)


def test_run_is_the_stages_one_after_the_other(spark, planted):
    import corpus_pipeline as C

    d, rows, gone = planted
    got = {r.doc_id for r in C.run(spark, d).select("doc_id").collect()}
    assert got and all(i % 10 == 0 for i in got & gone)


def test_empty_documents(spark, tmp_path):
    import corpus_pipeline as C

    d = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert C.run(spark, d).count() == 0


def test_a_worker_forgets_what_another_operator_kept(spark):
    from millrace.llm import common as K

    class Held:
        columns, schema = ["a"], K.fields(a="long")

        def mapInArrow(self, run, schema):
            return list(run(iter([])))

    K.forget()
    first = K.kept("one", dict)
    assert K.kept("one", dict) is first and list(K._keeps()) == ["one"]
    K.kept("two", list)
    assert list(K._keeps()) == ["two"]
    for keeps, left in (("two", ["two"]), (None, [])):
        assert K.arrow_map(Held(), lambda batches: ([] for _ in batches), K.fields(b="long"), keeps=keeps) == []
        assert list(K._keeps()) == left


def test_sentencepiece_does_not_depend_on_the_rows_at_once(spark, planted):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{planted[0]}/documents.parquet")
    got = [sorted(map(str, C.segment(docs.select("doc_id", "text"), C.MODEL, hide=("text",), at_once=n).collect())) for n in (7, 1000)]
    assert got[0] == got[1]
