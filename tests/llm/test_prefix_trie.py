import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import prefix_trie as P

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        out[c] = own.get(c - rest, [])[:h] + mine[h:]
    return out


def slow(rows):
    seqs = rebuilt(rows)
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversations(n=120, seed=2):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "ü long one", ""])))
    for c in range(200, 230):  # one common conversation, and one long common prefix with different ends
        rows += [(c, t, "user", f"common {t}") for t in range(12)]
    for c in range(300, 330):
        rows += [(c, t, "user", f"preamble {t}" if t < 15 else f"own {c}") for t in range(17)]
    rows += [(400, t, "user", f"{t % 7}") for t in range(400)]
    rows += [(500, None, None, None), (500, None, "user", None), (500, 3, None, "x"), (500, 3, None, "x"), (500, 1, "user", "y")]
    rows += [(None, 1, "user", "lost"), (-3, 0, "user", "negative"), (-5, 0, "user", "head"), (10**12 + 1, 0, "user", "far")]
    return rows + rows[5:8]


def nodes(df, **sizes):
    got = P.prefix_trie(df, **sizes)
    assert sorted(got.columns) == sorted(COLUMNS)
    return Counter(tuple(r[c] for c in COLUMNS) for r in got.collect())


@pytest.mark.parametrize("sizes", [{}, {"run": 7, "last": 4}, {"run": 50, "last": 10, "run_turns": 60}])
def test_equals_brute_force(spark, sizes, monkeypatch):
    monkeypatch.setattr(P, "RANGE", 37)
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS)
    assert nodes(df, **sizes) == slow(rows)


def test_one_conversation_of_very_many_rows(spark, monkeypatch):
    """Turns that are all equal, or all null, are still numbered by ranges."""
    monkeypatch.setattr(P, "RANGE", 100)
    rows = [(5, None, "user", "same")] * 700 + [(6, 1, "user", f"{i}") for i in range(700)] + [(7, 2, "user", "one")]
    ordered = P.turns(spark.createDataFrame(rows, TURNS)).collect()
    for c in (5, 6, 7):
        assert sorted(r.pos for r in ordered if r.c == c) == list(range(1, sum(x[0] == c for x in rows) + 1))
    assert max(Counter(r.part for r in ordered).values()) < 500
    assert nodes(spark.createDataFrame(rows, TURNS), run=2, last=2) == slow(rows)


def test_empty_tables_and_other_columns(spark):
    from pyspark.sql import functions as F

    assert P.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert P.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0
    rows = conversations(20)
    df = spark.createDataFrame(rows, TURNS).select("*", *[F.lit("mine").alias(c) for c in ("c", "POS", "Path", "n", "part", "size", "depth", "key")])
    assert nodes(df) == slow(rows)


def test_turnless_conversations_end_at_the_root(spark):
    """A conversation whose first turns are taken from a head that is absent may have none left."""
    rows = [(c, 0, "user", f"t{c}") for c in range(1, 40) if c % 5]
    want = slow(rows)
    root = next(k for k in want if k[1] == 0)
    assert root[7] != hashlib.sha256(b"").hexdigest()
    assert nodes(spark.createDataFrame(rows, TURNS)) == want
