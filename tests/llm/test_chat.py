import random
from collections import Counter

import pytest

from millrace.llm import chat as C

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(roles):
    """Least cost over all legal repairs, by trying every way to take each turn."""
    best = None

    def walk(k, state, cost):
        nonlocal best
        if best is not None and cost >= best:
            return
        if k == len(roles):
            best = min(x for x in (best, cost + len(C.ENDING[state]) * C.INSERT) if x is not None)
            return
        for p, q, c, _, _ in C.MOVES[roles[k]]:
            if p == state:
                walk(k + 1, q, cost + c // C.UNIT)

    walk(0, C.START, 0)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_repairs_are_cheapest(seed):
    rng = random.Random(seed)
    for _ in range(120):
        roles = [rng.randrange(4) for _ in range(rng.randrange(1, 7))]
        assert C.repair(roles, C.START, None)[0] // C.UNIT == cheapest(roles)


def legal(pieces):
    """Roles of the turns in order, after checking that they alternate as they must."""
    turns = [p.role for p in pieces if "merge" not in p.action]
    body = turns[1:] if turns[0] == "system" else turns
    assert body and len(body) % 2 == 0 and body == ["user", "assistant"] * (len(body) // 2)
    return turns


def rows(seed=3):
    rng = random.Random(seed)
    out = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, " User "]), f"c{c}t{t}")
           for c in range(12) for t in range(rng.randrange(1, 9))]
    out += [(50, t, rng.choice(["user", "assistant"]), f"long {t}") for t in range(100)]
    out += [(60, 0, "user", "same"), (60, 0, "user", "same"), (60, None, "system", None), (None, None, None, None), (None, 1, "user", "<|im_end|>")]
    return out


@pytest.mark.parametrize("segment", [1024, 7])
def test_every_turn_is_kept_in_order_and_conversations_are_legal(spark, segment):
    got = C.format_chat(spark.createDataFrame(rows(), TURNS), segment).collect()
    for conv in {r[0] for r in rows()}:
        pieces = sorted((p for p in got if p.conv_id == conv), key=lambda p: (p.segment, p.piece))
        legal(pieces)
        given = sorted((r for r in rows() if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        assert sorted(str(p.turn) for p in pieces if p.action != "insert") == sorted(str(r[1]) for r in given)
        assert sum(p.cost for p in pieces) * 1 == C.repair([C._role_number(r[2]) for r in given], C.START, None)[0] // C.UNIT
        text = "".join(p.rendered for p in pieces)
        assert text.count(C.OPEN) == text.count(C.CLOSE) == len([p for p in pieces if "merge" not in p.action]) and text.endswith(C.CLOSE + "\n")


def test_legal_conversations_stay_as_they_are(spark):
    given = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    pieces = sorted(C.format_chat(spark.createDataFrame(given, TURNS)).collect(), key=lambda p: p.piece)
    assert [p.action for p in pieces] == ["keep"] * 3
    assert "".join(p.rendered for p in pieces) == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n")
    assert C.format_chat(spark.createDataFrame([], TURNS)).count() == 0


def least_cost(roles):
    """Least cost of a repair, by a search that knows the rules only: which turn may follow which, and what a merge, a
    relabelled and an inserted turn cost."""
    import heapq

    after = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    heap, seen = [(0, 0, "start")], set()
    while heap:
        cost, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(roles) and (state == "assistant" or not roles):
            return cost
        for x in after[state]:
            heapq.heappush(heap, (cost + 2, i, x))
        for q in ("system", "user", "assistant") if i < len(roles) else ():
            change = 0 if q == roles[i] else 3
            if q == state:
                heapq.heappush(heap, (cost + 1 + change, i + 1, q))
            if q in after[state]:
                heapq.heappush(heap, (cost + change, i + 1, q))


@pytest.mark.parametrize("seed", range(12))
def test_costs_are_the_least_by_a_search_of_its_own(seed):
    rng = random.Random(seed)
    for _ in range(40):
        roles = [rng.choice(["system", "user", "assistant", "tool"]) for _ in range(rng.randrange(1, 9))]
        assert C.repair([C._role_number(r) for r in roles], C.START, None)[0] // C.UNIT == least_cost(roles)


def test_one_conversation_of_very_many_rows_of_one_turn(spark, monkeypatch):
    monkeypatch.setattr(C, "RANGE", 5000)
    rng = random.Random(1)
    roles = [rng.choice(["user", "assistant", "tool"]) for _ in range(60_000)]
    rows = [(9, 0 if i % 2 else None, r, f"t{i % 50}") for i, r in enumerate(roles)] + [(8, 0, "user", "a"), (10, 0, "assistant", "b")]
    got = C.format_chat(spark.createDataFrame(rows, TURNS)).collect()
    for conv in (8, 9, 10):
        pieces = sorted((p for p in got if p.conv_id == conv), key=lambda p: (p.segment, p.piece))
        legal(pieces)
        assert len([p for p in pieces if p.action != "insert"]) == sum(r[0] == conv for r in rows)
        turns = [p.turn for p in pieces if p.action != "insert"]
        assert turns == sorted(turns, key=lambda t: (t is not None, t or 0))
    sizes = Counter(p.segment for p in got if p.conv_id == 9 and p.action != "insert")
    assert max(sizes.values()) <= C.SEGMENT and len(sizes) >= 58


def test_other_columns_may_have_any_name(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(), TURNS)
    more = df.select("*", *[F.lit("mine").alias(c) for c in ("c", "SEG", "row", "piece", "Segment", "entry", "h", "mix")])
    key = lambda x: sorted(map(tuple, x.collect()), key=repr)
    assert key(C.format_chat(more)) == key(C.format_chat(df))
