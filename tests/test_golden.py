"""End-to-end cases with literal rows: a feed in, the expected table out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import transforms as X
from millrace.functions.casts import typed
from millrace.operators.apply import apply
from millrace.operators.envelope import to_events
from millrace.operators.evolve import conform, schema_diff
from millrace.operators.fold import fold
from millrace.session import work_dir
from millrace.sinks import tables
from millrace.sources.snapshot import snapshot_all
from millrace.spec import SchemaChange, TableSpec
from millrace.streaming.pipeline import feed_batch, materialize, snapshot_batch
from tests.feeds import control, dml, feed, numbered, rows, run_batches

BIG = "x" * 100_000


def spec_of(*columns, **kw):
    return TableSpec.of("public.t", columns, pk=["id"], **kw)


def amounts():
    return spec_of(("id", "integer", False), ("name", "text"), ("amount", "numeric"))


def people(*names, key="name"):
    return [("I", {"id": str(i), key: n}) for i, n in enumerate(names, start=1)]


def test_basic_insert(spark):
    spec = amounts()
    ops = [("I", {"id": "1", "name": "alice", "amount": "100.50"}), ("I", {"id": "2", "name": "bob", "amount": "200.75"}),
           ("I", {"id": "3", "name": "charlie", "amount": "300.00"})]
    assert run_batches(spark, spec, [ops]) == [(1, "alice", "100.50"), (2, "bob", "200.75"), (3, "charlie", "300.00")]


def test_update(spark):
    spec = spec_of(("id", "integer", False), ("name", "text"), ("score", "integer"))
    ops = [("I", {"id": str(i), "name": n, "score": str(10 * i)}) for i, n in enumerate(("alice", "bob", "charlie"), 1)]
    ops.append(("U", {"id": "2", "name": "bob", "score": "99"}))
    expected = [(1, "alice", 10), (2, "bob", 99), (3, "charlie", 30)]
    assert run_batches(spark, spec, [ops]) == expected
    assert run_batches(spark, spec, [ops[:3], ops[3:]]) == expected


def test_delete(spark):
    spec = spec_of(("id", "integer", False), ("name", "text"))
    ops = people("alice", "bob", "charlie", "diana") + [("D", {"id": "2"}), ("D", {"id": "4"})]
    for batches in ([ops], [ops[:4], ops[4:]]):
        assert run_batches(spark, spec, batches) == [(1, "alice"), (3, "charlie")]


def test_mixed_operations(spark):
    spec = spec_of(("id", "integer", False), ("name", "text"), ("status", "text"))

    def row(i, n, s="active"):
        return {"id": str(i), "name": n, "status": s}

    ops = [("I", row(i, n)) for i, n in enumerate(("alice", "bob", "charlie", "diana", "eve"), 1)] + [
        ("U", row(1, "alice", "inactive")), ("U", row(3, "charlie", "inactive")), ("D", row(5, "eve")),
        ("I", row(6, "frank")), ("U", row(2, "robert"))]
    expected = [(1, "alice", "inactive"), (2, "robert", "active"), (3, "charlie", "inactive"), (4, "diana", "active"),
                (6, "frank", "active")]
    for batches in ([ops], [ops[:5], ops[5:]], [[o] for o in ops]):
        assert run_batches(spark, spec, batches) == expected


def test_column_types(spark):
    spec = spec_of(("id", "integer", False), ("name", "text", False), ("age", "integer", False), ("balance", "numeric"),
                   ("is_active", "boolean", False), ("score", "double precision"), ("created_at", "timestamptz", False),
                   ("birth_date", "date"))
    ops = [("I", dict(zip(spec.columns, v))) for v in (
        ("1", "alice", "30", "1000.50", "t", "95.5", "2025-01-15 10:30:00+00", "1995-03-20"),
        ("2", "bob", "25", None, "f", None, "2025-06-20 14:00:00+00", None),
        ("3", "charlie", "35", "5000.00", "t", "88.2", "2025-12-01 08:15:30+00", "1990-07-04"))]
    state = apply(spark.createDataFrame([], spec.schema), fold(to_events(feed(spark, numbered(spec, ops)), spec), spec), spec)
    got = rows(state.withColumn("created_at", F.col("created_at").cast("string")), spec)
    assert got == [
        (1, "alice", 30, "1000.50", True, 95.5, "2025-01-15 10:30:00", dt.date(1995, 3, 20)),
        (2, "bob", 25, None, False, None, "2025-06-20 14:00:00", None),
        (3, "charlie", 35, "5000.00", True, 88.2, "2025-12-01 08:15:30", dt.date(1990, 7, 4))]


# -- unchanged columns --------------------------------------------------------


def payload_spec(**kw):
    return spec_of(("id", "integer", False), ("label", "text"), ("payload", "text"), maybe_unchanged=("payload",), **kw)


def split_ways(ops):
    return [ops], [ops[:1], ops[1:]], [[o] for o in ops]


def test_unchanged_payload(spark):
    ops = [("I", {"id": str(i), "label": f"row{i}", "payload": BIG}) for i in (1, 2, 3)]
    ops.append(("U", {"id": "2", "label": "row2_updated"}, ["payload"]))
    for batches in split_ways(ops):
        got = [(i, lb, len(p)) for i, lb, p in run_batches(spark, payload_spec(), batches)]
        assert got == [(1, "row1", 100000), (2, "row2_updated", 100000), (3, "row3", 100000)]


def test_unchanged_in_successive_updates(spark):
    ops = [("I", {"id": "1", "label": "orig", "payload": BIG}), ("U", {"id": "1", "label": "first"}, ["payload"]),
           ("U", {"id": "1", "label": "second"}, ["payload"])]
    for batches in split_ways(ops):
        assert run_batches(spark, payload_spec(), batches) == [(1, "second", BIG)]


def test_unchanged_then_delete(spark):
    ops = [("I", {"id": "1", "label": "keep", "payload": BIG}), ("I", {"id": "2", "label": "gone", "payload": BIG}),
           ("U", {"id": "2", "label": "soon"}, ["payload"]), ("D", {"id": "2"})]
    for batches in split_ways(ops):
        assert run_batches(spark, payload_spec(), batches) == [(1, "keep", BIG)]


def test_null_is_not_unchanged(spark):
    spec = spec_of(("id", "integer", False), ("label", "text"), ("bio", "text"), ("payload", "text"))
    first = [("I", {"id": "1", "label": "a", "bio": BIG, "payload": BIG}), ("I", {"id": "2", "label": "b", "bio": BIG, "payload": None}),
             ("I", {"id": "3", "label": "c", "bio": None, "payload": BIG})]
    then = [("U", {"id": "1", "label": "updated"}, ["bio", "payload"]), ("U", {"id": "2", "label": "updated", "payload": None}, ["bio"]),
            ("U", {"id": "3", "label": "updated", "bio": None}, ["payload"])]
    for batches in ([first + then], [first, then]):
        got = [(i, lb, b and len(b), p and len(p)) for i, lb, b, p in run_batches(spark, spec, batches)]
        assert got == [(1, "updated", 100000, 100000), (2, "updated", 100000, None), (3, "updated", None, 100000)]


def test_unchanged_then_set(spark):
    ops = [("I", {"id": "1", "label": "orig", "payload": "A" * 100000}), ("U", {"id": "1", "label": "step1"}, ["payload"]),
           ("U", {"id": "1", "label": "step1", "payload": "Z" * 100000})]
    for batches in split_ways(ops):
        (i, label, p), = run_batches(spark, payload_spec(), batches)
        assert (i, label, p[0], len(p)) == (1, "step1", "Z", 100000)


def test_unchanged_across_flushes_of_a_partitioned_table(spark):
    """Through the stored tables: events commits, materialization, merge-on-read scan."""
    spec = spec_of(("id", "integer", False), ("region", "text"), ("label", "text"), ("payload", "text"),
                   partition=("region",), maybe_unchanged=("payload",))
    root = work_dir(spark, "golden")
    first = [("I", {"id": "1", "region": "us", "label": "orig", "payload": BIG}),
             ("I", {"id": "2", "region": "eu", "label": "orig", "payload": BIG})]
    then = [("U", {"id": "1", "region": "us", "label": "updated"}, ["payload"]),
            ("U", {"id": "2", "region": "eu", "label": "updated"}, ["payload"])]
    for i, ops in enumerate((first, then)):
        feed_batch(feed(spark, numbered(spec, ops, 1 + 10 * i)), i, [spec], root + "/ev")
        materialize(spark, [spec], root + "/ev", root + "/tb")
    got = rows(tables.read_state(spark, root + "/tb", spec).withColumn("payload", F.length("payload")), spec)
    assert got == [(1, "us", "updated", 100000), (2, "eu", "updated", 100000)]


def test_snapshot_then_insert(spark):
    spec = amounts()
    source = spark.createDataFrame([(1, "alice", "100.50"), (2, "bob", "200.75"), (3, "charlie", "300.00")], spec.schema)
    root = work_dir(spark, "golden")
    snapshot_batch(snapshot_all({"public.t": source}, F.current_timestamp()), [spec], root + "/ev")
    feed_batch(feed(spark, [dml(spec, "I", {"id": "4", "name": "diana", "amount": "400.25"}, xid=7, pos=50),
                            control("COMMIT", 7, 51)]), 1, [spec], root + "/ev")
    materialize(spark, [spec], root + "/ev", root + "/tb")
    assert rows(tables.read_state(spark, root + "/tb", spec), spec) == [
        (1, "alice", "100.50"), (2, "bob", "200.75"), (3, "charlie", "300.00"), (4, "diana", "400.25")]


# -- partition transforms -----------------------------------------------------

TIMES = {
    "day(created_at)": (["2025-01-15 10:00:00", "2025-01-15 14:30:00", "2025-02-20 09:00:00", "2025-02-20 18:45:00",
                         "2025-03-10 12:00:00"], [20103, 20103, 20139, 20139, 20157]),
    "month(created_at)": (["2025-01-15 10:00:00", "2025-01-20 14:30:00", "2025-02-10 09:00:00", "2025-02-20 18:45:00",
                           "2025-03-10 12:00:00"], [660, 660, 661, 661, 662]),
    "year(created_at)": (["2023-06-15 10:00:00", "2023-11-20 14:30:00", "2024-03-10 09:00:00", "2024-08-20 18:45:00",
                          "2025-01-10 12:00:00"], [53, 53, 54, 54, 55]),
    "hour(created_at)": (["2025-01-15 10:00:00", "2025-01-15 10:30:00", "2025-01-15 14:00:00", "2025-01-15 14:45:00",
                          "2025-01-15 20:00:00"], [482482, 482482, 482486, 482486, 482492]),
}


def transformed(spark, expr, source_type, values):
    """Text values typed as declared, then transformed; the path component of each."""
    col = X.parse(expr)[2]
    spec = TableSpec.of("public.t", [("n", "integer"), (col, source_type)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, {col} string")
    df = df.withColumn(col, typed(F.col(col), source_type))
    fields = X.partition_fields([expr], spec)
    out = X.with_partitions(df, fields).select("n", X.partition_path(fields).alias("p")).orderBy("n").collect()
    return [r["p"].split("=", 1)[1] for r in out]


@pytest.mark.parametrize("expr", TIMES)
def test_time_partitions(spark, expr):
    values, expected = TIMES[expr]
    assert transformed(spark, expr, "timestamptz", [v + "+00" for v in values]) == [str(e) for e in expected]


@pytest.mark.parametrize("expr, source_type, values, expected", [
    ("region", "text", ["us-east", "eu-west", "us-east", "ap-south", "eu-west"], ["us-east", "eu-west", "us-east", "ap-south", "eu-west"]),
    ("bucket[4](id)", "integer", ["1", "2", "3", "4", "5"], ["2", "3", "1", "3", "2"]),
    ("truncate[3](name)", "text", ["alice", "bob", "charlie", "dave", "eve"], ["ali", "bob", "cha", "dav", "eve"]),
    ("truncate[10](id)", "integer", ["1", "15", "-1", "25", "100"], ["0", "10", "-10", "20", "100"]),
    ("truncate[100](amount)", "bigint", ["150", "250", "-50", "999", "0"], ["100", "200", "-100", "900", "0"]),
    ("truncate[50](price)", "numeric(10,2)", ["10.65", "25.30", "99.99", "-10.65", "0.00"], ["10.50", "25.00", "99.50", "-11.00", "0.00"]),
    ("truncate[3](data)", "bytea", ["\\x0102030405", "\\xaabbccddee", "\\xff00ff00ff", "\\xdeadbeef", "\\x0102"],
     ["AQID", "qrvM", "%2FwD%2F", "3q2%2B", "AQI%3D"]),
])
def test_other_partitions(spark, expr, source_type, values, expected):
    assert transformed(spark, expr, source_type, values) == expected


# -- transactions ---------------------------------------------------------------


def test_two_transactions(spark):
    spec = amounts()
    names = ("alice", "bob", "charlie", "dave", "eve")
    ins = [dml(spec, "I", {"id": str(i), "name": n, "amount": f"{i}00.00"}, xid=100 if i < 4 else 101, pos=10 * i)
           for i, n in enumerate(names, 1)]
    root = work_dir(spark, "golden")
    feed_batch(feed(spark, [control("BEGIN", 100, 5), *ins[:3], control("COMMIT", 100, 35), control("BEGIN", 101, 36), *ins[3:]]),
               0, [spec], root + "/ev")
    materialize(spark, [spec], root + "/ev", root + "/tb")
    assert [r[0] for r in rows(tables.read_state(spark, root + "/tb", spec), spec)] == [1, 2, 3]
    feed_batch(feed(spark, [control("COMMIT", 101, 55)]), 1, [spec], root + "/ev")
    materialize(spark, [spec], root + "/ev", root + "/tb")
    assert rows(tables.read_state(spark, root + "/tb", spec), spec) == [
        (i, n, f"{i}00.00") for i, n in enumerate(names, 1)]


# -- schema evolution -----------------------------------------------------------


def evolving(spark, spec, steps):
    """steps: lists of operations with schema changes between them -> (rows, final spec)."""
    state, pos = spark.createDataFrame([], spec.schema), 1
    for step in steps:
        if isinstance(step, SchemaChange):
            spec = spec.evolve(step)
            state = conform(state, spec)
            continue
        events = to_events(feed(spark, numbered(spec, step, pos)), spec)
        state = apply(state, fold(events, spec), spec)
        pos += len(step)
    return state, spec


def ins(**values):
    return ("I", {k: None if v is None else str(v) for k, v in values.items()})


def check(spark, spec, steps, expected, *cols):
    state, final = evolving(spark, spec, steps)
    assert rows(state, final, *cols) == expected


def test_add_column(spark):
    check(spark, spec_of(("id", "integer", False), ("name", "text")),
          [[ins(id=1, name="alice"), ins(id=2, name="bob")], SchemaChange(added=(("score", "integer"),)),
           [ins(id=3, name="charlie", score=100), ins(id=4, name="diana", score=200)]],
          [(1, None), (2, None), (3, 100), (4, 200)], "id", "score")


def test_widen_int_to_bigint(spark):
    check(spark, spec_of(("id", "integer", False), ("value", "integer")),
          [[ins(id=1, value=100), ins(id=2, value=200)], SchemaChange(retyped=(("value", "bigint"),)),
           [ins(id=3, value=3000000000), ins(id=4, value=4000000000)]],
          [(1, 100), (2, 200), (3, 3000000000), (4, 4000000000)])


def test_widen_float_to_double(spark):
    state, final = evolving(spark, spec_of(("id", "integer", False), ("score", "real")),
          [[ins(id=1, score=1.5), ins(id=2, score=2.5)], SchemaChange(retyped=(("score", "double precision"),)),
           [ins(id=3, score=3.141592653589793), ins(id=4, score=2.718281828459045)]])
    assert rows(state.withColumn("score", F.round("score", 6)), final) == [(1, 1.5), (2, 2.5), (3, 3.141593), (4, 2.718282)]


def test_drop_column(spark):
    check(spark, spec_of(("id", "integer", False), ("name", "text"), ("temp", "text"), ("amount", "numeric")),
          [[ins(id=1, name="a", temp="x", amount="100.50"), ins(id=2, name="b", temp="y", amount="200.75")],
           SchemaChange(dropped=("temp",)), [ins(id=3, name="c", amount="300.00"), ins(id=4, name="d", amount="400.00")]],
          [(1, "a", "100.50"), (2, "b", "200.75"), (3, "c", "300.00"), (4, "d", "400.00")])


def test_add_column_with_source_default(spark):
    """The source's default is not filled into rows copied before the change."""
    check(spark, spec_of(("id", "integer", False), ("name", "text")),
          [people("alice", "bob"), SchemaChange(added=(("status", "text"),)),
           [ins(id=3, name="charlie", status="active"), ins(id=4, name="diana", status="inactive")]],
          [(1, None), (2, None), (3, "active"), (4, "inactive")], "id", "status")


def test_several_changes_at_once(spark):
    check(spark, spec_of(("id", "integer", False), ("name", "text"), ("temp", "text"), ("value", "integer")),
          [[ins(id=1, name="a", temp="x", value=100), ins(id=2, name="b", temp="y", value=200)],
           SchemaChange(added=(("score", "bigint"),), dropped=("temp",), retyped=(("value", "bigint"),)),
           [ins(id=3, name="c", value=3000000000, score=90), ins(id=4, name="d", value=4000000000, score=95)]],
          [(100, None), (200, None), (3000000000, 90), (4000000000, 95)], "value", "score")


def test_add_then_update(spark):
    check(spark, spec_of(("id", "integer", False), ("name", "text")),
          [people("alice", "bob"), SchemaChange(added=(("score", "integer"),)),
           [("U", {"id": "1", "name": "alice", "score": "50"}), ins(id=3, name="charlie", score=100),
            ("U", {"id": "2", "name": "bob", "score": "75"})]],
          [(1, 50), (2, 75), (3, 100)], "id", "score")


def test_rename_column(spark):
    spec = spec_of(("id", "integer", False), ("name", "text"), ("value", "integer"))
    renamed = spec.rename("value", "score")
    assert renamed.field_id("score") == 4
    change = schema_diff([(c, spec.source_type(c)) for c in spec.columns], [(c, renamed.source_type(c)) for c in renamed.columns])
    assert change == SchemaChange(added=(("score", "integer"),), dropped=("value",))
    check(spark, spec, [[ins(id=1, name="a", value=100), ins(id=2, name="b", value=200)], change,
                        [ins(id=3, name="c", score=300), ins(id=4, name="d", score=400)]],
          [(1, None), (2, None), (3, 300), (4, 400)], "id", "score")


def test_varchar_to_text(spark):
    spec = spec_of(("id", "integer", False), ("name", "varchar"), ("value", "integer"))
    change, long = SchemaChange(retyped=(("name", "text"),)), "n" * 63
    assert spec.is_noop(change)
    check(spark, spec, [[ins(id=1, name="a", value=1), ins(id=2, name="b", value=2)], change, [ins(id=3, name=long, value=3)]],
          [(1, "a", 1), (2, "b", 2), (3, long, 3)])


def test_successive_changes(spark):
    check(spark, spec_of(("id", "integer", False), ("name", "text")),
          [people("alice"), SchemaChange(added=(("score", "integer"),)), [ins(id=2, name="bob", score=100)],
           SchemaChange(added=(("level", "text"),)), [ins(id=3, name="charlie", score=200, level="gold")]],
          [(1, "alice", None, None), (2, "bob", 100, None), (3, "charlie", 200, "gold")])
