"""Any split of a random log into batches gives what a row-by-row replay gives."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from millrace.operators import mor
from millrace.operators.apply import apply, resolve
from millrace.operators.fold import fold
from millrace.spec import TableSpec
from tests.feeds import replay

SPEC = TableSpec.of("public.r", [("k", "bigint", False), ("a", "integer"), ("b", "text"), ("c", "text")], pk=["k"])
SCHEMA = T.StructType([
    T.StructField("_op", T.StringType()), T.StructField("_seq", T.LongType()),
    T.StructField("_unchanged_cols", T.StringType()), *SPEC.schema.fields])


def random_log(seed, keys=60, n=900):
    """A valid log: inserts only of absent keys, updates and deletes only of present ones.
    A third of all events hits one key."""
    rnd, alive, out = random.Random(seed), set(), []
    for seq in range(1, n + 1):
        k = 0 if rnd.random() < 0.34 else rnd.randrange(1, keys)
        op = rnd.choice("UUUD") if k in alive else "I"
        row = {"k": k, "a": rnd.choice([None, rnd.randrange(100)]), "b": rnd.choice([None, f"b{seq}"]), "c": f"c{seq}"}
        left = [c for c in "abc" if op == "U" and rnd.random() < 0.4]
        for c in left:
            row[c] = None
        if op == "D":
            row.update(a=None, b=None, c=None)
        alive.discard(k) if op == "D" else alive.add(k)
        out.append({"_op": op, "_seq": seq, "_unchanged": left, **row})
    return out


def frame(spark, log):
    return spark.createDataFrame(
        [(e["_op"], e["_seq"], ",".join(e["_unchanged"]) or None, e["k"], e["a"], e["b"], e["c"]) for e in log], SCHEMA)


def cuts(seed, n, parts):
    rnd = random.Random(seed * 31)
    return [0, *sorted(rnd.sample(range(1, n), parts - 1)), n]


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 2), (3, 5), (4, 9)])
@pytest.mark.parametrize("narrow", [False, True])
def test_any_split_equals_replay(spark, seed, parts, narrow):
    log = random_log(seed)
    edges = cuts(seed, len(log), parts)
    state = spark.createDataFrame([], SPEC.schema)
    for lo, hi in zip(edges, edges[1:]):
        batch = log[lo:hi]
        random.Random(seed).shuffle(batch)  # input order must not matter
        out = apply(state, fold(frame(spark, batch), SPEC), SPEC, narrow=narrow)
        state = spark.createDataFrame(out.collect(), SPEC.schema)
    got = {(r["k"],): {c: r[c] for c in SPEC.columns} for r in state.collect()}
    assert got == replay(log, SPEC.pk, SPEC.columns)


@pytest.mark.parametrize("seed", [5, 6])
def test_merge_on_read_equals_replay(spark, seed):
    log = random_log(seed)
    edges = cuts(seed, len(log), 4)
    data = spark.createDataFrame([], T.StructType([T.StructField("_commit", T.LongType()), *SPEC.schema.fields]))
    deletes = data.select("_commit", "k")
    for commit, (lo, hi) in enumerate(zip(edges, edges[1:])):
        ready = resolve(fold(frame(spark, log[lo:hi]), SPEC), mor.scan(data, deletes, SPEC.pk), SPEC)
        new_deletes, new_data = mor.split(ready, SPEC, commit=commit)
        data = spark.createDataFrame(data.unionByName(new_data).collect(), data.schema)
        deletes = spark.createDataFrame(deletes.unionByName(new_deletes).collect(), deletes.schema)
        got = {(r["k"],): r.asDict() for r in mor.scan(data, deletes, SPEC.pk).collect()}
        assert got == replay(log[:hi], SPEC.pk, SPEC.columns)
        packed = mor.compact(data, deletes, SPEC.pk, commit)
        assert packed.count() == len(got)
    # Every earlier commit can still be read.
    for commit, hi in enumerate(edges[1:]):
        got = {(r["k"],): r.asDict() for r in mor.scan(data, deletes, SPEC.pk, as_of=commit).collect()}
        assert got == replay(log[:hi], SPEC.pk, SPEC.columns)


def test_narrowed_bookkeeping_gives_the_same(spark):
    """Declaring which columns may be left out changes the plan, not the result."""
    log = [e | {"_unchanged": [c for c in e["_unchanged"] if c == "c"]} for e in random_log(7)]
    few = TableSpec.of(SPEC.name, [("k", "bigint", False), ("a", "integer"), ("b", "text"), ("c", "text")],
                       pk=["k"], maybe_unchanged=("c",))
    df = frame(spark, log)
    wide, slim = (fold(df, s).filter(F.col("op") != "D").select(*SPEC.columns) for s in (SPEC, few))
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(map(tuple, slim.collect()), key=repr)


def test_insert_on_existing_key_replaces(spark):
    log = [{"_op": "I", "_seq": 1, "_unchanged": [], "k": 1, "a": 1, "b": "x", "c": "x"},
           {"_op": "I", "_seq": 2, "_unchanged": [], "k": 1, "a": 2, "b": None, "c": "y"}]
    base = apply(spark.createDataFrame([], SPEC.schema), fold(frame(spark, log[:1]), SPEC), SPEC)
    out = apply(base, fold(frame(spark, log[1:]), SPEC), SPEC)
    assert [tuple(r) for r in out.collect()] == [(1, 2, None, "y")]
