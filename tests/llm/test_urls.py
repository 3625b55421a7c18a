import re
from itertools import combinations

import pytest

from millrace.llm import urls as U
from millrace.llm.queries_urls import RULES
from tests.llm.tables import clashing

PAGES = "page_id long, url string"
LABELS = "doc_id long, toxic int"

URLS = [
    "http://Example.com/en/1", "https://a.example.com/en/", "https://www.example.com/en/x?q=1", "http://sub.www.example.com/en/2#top",
    "http://x.net/es/1", "http://net/fr/", "http://x.net/fr", "http://x.net/de/?u=http://y.com/", "ftp://com/", "http://com", "http://notcom/en/",
    "http://a.com?x=1", "//a.com/", "a.com/", "", None, "http://ÄB.com/", "http:///path", "http://h.org/a/b/12/c?k=v&k2&=#f", "://x.org/p",
]


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def pages(spark, n=300):
    made = [f"http://{'spam' if i % 4 == 0 else 'fine'}{i % 7}.org/{['shop', 'news'][i % 2]}/{i}" + ("?promo=1" if i % 4 == 0 else "") for i in range(n)]
    return spark.createDataFrame([(i, u) for i, u in enumerate(made + URLS + URLS[:3])] + [(None, None)], PAGES)


def labels(spark, n=300):
    return spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, n, 2)] + [(None, 1), (1, None), (2, 0)], LABELS)


def test_host_path_and_fixed_rules_equal_brute_force(spark):
    got = U.judge(clashing(pages(spark), ["host", "RULE", "Verdict"]), RULES, labels(spark)).collect()
    assert len(got) == pages(spark).count()
    for r in got:
        host, path = slow_parts(r.url)
        rule = slow_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None), r.url
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)


def test_mined_rules_equal_brute_force(spark):
    rows = U.with_parts(pages(spark)).select("page_id", U.tokens().alias("tokens")).where("page_id < 300").collect()
    label = {i: "block" if i % 4 == 0 else "allow" for i in range(300)}
    df = spark.createDataFrame([(r.tokens, label[r.page_id]) for r in rows], "tokens array<string>, label string")
    got = {(tuple(r["items"]), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in U.mine(df, 0.02, 0.9).collect()}
    total, hits, joint = len(rows), {}, {}
    for r in rows:
        for k in range(1, len(r.tokens) + 1):
            for s in combinations(sorted(r.tokens), k):
                hits[s] = hits.get(s, 0) + 1
                joint[s, label[r.page_id]] = joint.get((s, label[r.page_id]), 0) + 1
    sure = {(s, v): n / hits[s] for (s, v), n in joint.items() if n >= 0.02 * total and n / hits[s] >= 0.9}
    want = {k: c for k, c in sure.items() if not any(sure.get((tuple(x for x in k[0] if x != g), k[1]), 0) >= c for g in k[0])}
    assert got == {k: (round(c, 9), round(joint[k] / total, 9)) for k, c in want.items()}


def test_unlabelled_pages_follow_the_mined_rules(spark):
    got = {r.page_id: r.verdict for r in U.judge(pages(spark), RULES, labels(spark)).collect()}
    assert all(got[i] == ("block" if i % 4 == 0 else "allow") for i in range(1, 300, 2))
    assert got[300 + URLS.index(None)] == "allow"


@pytest.mark.parametrize("given", [None, []])
def test_without_labels_and_without_pages(spark, given):
    held = None if given is None else spark.createDataFrame(given, LABELS)
    assert U.judge(spark.createDataFrame([], PAGES), RULES, held).count() == 0
    only = spark.createDataFrame([(1, None), (2, "nothing")], PAGES)
    assert [r.verdict for r in U.judge(only, RULES, held).collect()] == ["allow", "allow"]


def test_no_python_runs_on_executors(spark):
    plan = U.judge(pages(spark), RULES, labels(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
