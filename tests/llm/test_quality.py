import re
from collections import Counter

import pytest

from millrace.llm import quality as Q
from tests.llm.tables import clashing, documents, frame

MORE = [
    (900, "a b c d e f g h i j", None, None, None), (901, "a b c d e a b c d e x y z w v u t s r q p o", None, None, None),
    (902, "word\nword\nother\n\n  \nword one two three four five six seven", None, None, None),
    (903, "# # * one $ two % three & four | five < six > seven eight nine ten", None, None, None),
    (904, "THIS IS ALL LOUD TEXT THAT SHOUTS AT EVERY READER OF IT", None, None, None),
    (905, "1234567 890 1234567 8901 234567 89012 3456 78901 23456 7890 1 2 3", None, None, None),
    (906, " ".join(["same five words here now"] * 300), None, None, None),
]


def slow(text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {r for r, n in Counter(runs).items() if n > 1}
    covered = {i + k for i, r in enumerate(runs) if r in twice for k in range(5)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    dup, symbols, chars = len(lines) - len(set(lines)), len(re.findall(r"[#*$%&|<>]", t)), sum(map(len, w))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    upper, digits = sum(c.isupper() and c.isalpha() for c in t), len(re.findall("[0-9]", t))
    kept = not (failed or 10 * symbols > len(w) or chars < 2 * len(w) or chars > 15 * len(w) or 2 * dup > len(lines)
                or 10 * upper > 4 * len(t) or 2 * digits > len(t))
    return len(w), chars, symbols, dup, len(covered), failed, kept


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@pytest.fixture
def rows():
    return documents() + MORE


def test_measures_equal_brute_force(spark, rows):
    df = frame(spark, rows)
    got = Q.measures(clashing(df, NAMES), Q.estimate(df)).collect()
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in got) == Counter((r[0], *slow(r[1])) for r in rows)


def test_order_changes_nothing(spark, rows):
    df = frame(spark, rows)
    order = Q.estimate(df)
    assert {e.rule.name for e in order} == {r.name for r in Q.RULES}
    assert [e.selectivity / e.cost for e in order] == sorted((e.selectivity / e.cost for e in order), reverse=True)
    for o in (order, order[::-1]):
        got = Q.parts(df, "text").withColumn("v", Q.verdict(o)).collect()
        assert Counter((r.doc_id, r.v) for r in got) == Counter((r[0], slow(r[1])[-1]) for r in rows)


def test_keep_is_the_verdict_and_leaves_columns(spark, rows):
    df = clashing(frame(spark, rows), NAMES)
    kept = Q.keep(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if slow(r[1])[-1])
    assert Q.keep(frame(spark, [])).count() == 0


def test_no_python_runs_on_executors(spark, rows):
    df = frame(spark, rows)
    plan = Q.measures(df, Q.estimate(df))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
