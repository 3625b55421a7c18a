"""Commits, crashes, retries, time travel, streams."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions.transforms import partition_dir
from millrace.session import work_dir
from millrace.sinks import commits, events as event_sink, progress, tables
from millrace.sources.feed import FEED_SCHEMA, read_feed
from millrace.sources.snapshot import pending_tables
from millrace.spec import SchemaChange, TableSpec
from millrace.streaming import pipeline
from millrace.streaming.gate import read_gated, run_gate
from tests.feeds import NOW, control, dml, feed, numbered, rows

EVENTS = TableSpec.of("public.counted", [("id", "integer", False), ("value", "integer")], pk=["id"])
ORDERS = TableSpec.of("public.orders", [("id", "integer", False), ("amount", "integer")], pk=["id"])
PAYMENTS = TableSpec.of("public.payments", [("id", "integer", False), ("order_id", "integer")], pk=["id"])


def one_tx(spec, xid, *ids):
    return [dml(spec, "I", {spec.columns[0]: str(i), spec.columns[1]: str(i * 10)}, xid=xid, pos=xid * 100 + n)
            for n, i in enumerate(ids)]


def count_events(spark, root, spec=EVENTS):
    return event_sink.read_events(spark, root, spec).count()


def test_position_moves_only_with_commits(spark):
    root = work_dir(spark, "t")
    pipeline.feed_batch(feed(spark, one_tx(EVENTS, 1, 1, 2)), 0, [EVENTS], root, "p")
    assert progress.load_progress(spark, root, "p")["lsn"] == 0
    assert count_events(spark, root) == 0
    pipeline.feed_batch(feed(spark, [control("COMMIT", 1, 199), *one_tx(EVENTS, 2, 3)]), 1, [EVENTS], root, "p")
    assert progress.load_progress(spark, root, "p")["lsn"] == 199
    assert count_events(spark, root) == 2


def test_failed_flush_is_retried_without_duplicates(spark, monkeypatch):
    root = work_dir(spark, "t")
    batch = feed(spark, [*one_tx(EVENTS, 1, 1, 2, 3), control("COMMIT", 1, 199)])

    def refuse(*a, **k):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(commits, "publish", refuse)
        with pytest.raises(OSError):
            pipeline.feed_batch(batch, 0, [EVENTS], root, "p")
    assert commits.last_commit(spark, root) == -1 and count_events(spark, root) == 0
    assert progress.load_progress(spark, root, "p") == progress.EMPTY
    for _ in range(2):
        pipeline.feed_batch(batch, 0, [EVENTS], root, "p")
        assert count_events(spark, root) == 3


def test_two_tables_become_visible_together(spark, monkeypatch):
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    specs = [ORDERS, PAYMENTS]
    pipeline.feed_batch(feed(spark, [*one_tx(ORDERS, 1, 1, 2), *one_tx(PAYMENTS, 1, 7), control("COMMIT", 1, 199)]),
                        0, specs, ev)
    real = commits.write_part

    def dies_for_one(df, root, table, *a, **k):
        if table == "payments/data":
            raise OSError("lost")
        real(df, root, table, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(commits, "write_part", dies_for_one)
        with pytest.raises(OSError):
            pipeline.materialize(spark, specs, ev, tb)
    assert [tables.read_state(spark, tb, s).count() for s in specs] == [0, 0]
    pipeline.materialize(spark, specs, ev, tb)
    assert [tables.read_state(spark, tb, s).count() for s in specs] == [2, 1]


def test_materializer_picks_up_where_it_stopped(spark):
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    for i in range(3):
        pipeline.feed_batch(feed(spark, [*one_tx(EVENTS, i + 1, i, i + 10), control("COMMIT", i + 1, 1000 * (i + 1))]),
                            i, [EVENTS], ev)
        if i != 1:  # one cycle missed
            assert pipeline.materialize(spark, [EVENTS], ev, tb) is not None
            assert pipeline.materialize(spark, [EVENTS], ev, tb) is None
    assert [r[0] for r in rows(tables.read_state(spark, tb, EVENTS), EVENTS)] == [0, 1, 2, 10, 11, 12]
    # Earlier commits and the compacted table read the same rows as before.
    before = rows(tables.read_state(spark, tb, EVENTS, as_of=0), EVENTS)
    state = rows(tables.read_state(spark, tb, EVENTS), EVENTS)
    packed = tables.compact(spark, tb, EVENTS)
    data, deletes = tables.read_parts(spark, tb, EVENTS)
    assert deletes.count() == 0 and data.select("_commit").distinct().collect()[0][0] == packed
    assert rows(tables.read_state(spark, tb, EVENTS), EVENTS) == state
    assert rows(tables.read_state(spark, tb, EVENTS, as_of=0), EVENTS) == before
    # And the cycle after a compaction goes on from the same place.
    assert pipeline.materialize(spark, [EVENTS], ev, tb) is None


def test_table_without_key_stays_a_log(spark):
    log_only = TableSpec.of("public.clicks", [("id", "integer"), ("value", "integer")])
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    pipeline.feed_batch(feed(spark, [*one_tx(log_only, 1, 1, 1), control("COMMIT", 1, 199)]), 0, [log_only], ev)
    assert count_events(spark, ev, log_only) == 2
    assert pipeline.materialize(spark, [log_only], ev, tb) is None


def test_rewrite_touches_only_its_partitions(spark):
    spec = TableSpec.of("public.t", [("id", "integer", False), ("region", "text"), ("v", "integer")], pk=["id"],
                        partition=("region",))
    from millrace.operators.envelope import to_events
    from millrace.operators.fold import fold

    root = work_dir(spark, "t")

    def go(commit, *ops):
        ops = [(op, {k: None if v is None else str(v) for k, v in row.items()}) for op, row in ops]
        folded = fold(to_events(feed(spark, numbered(spec, ops)), spec), spec).persist()
        tables.merge_table(folded, spec, root, commit)
        return rows(tables.read_versions(spark, root, spec), spec)

    def row(i, r, v):
        return {"id": i, "region": r, "v": v}

    go(0, *[("I", row(i, r, i)) for i, r in enumerate(["us", "us", "eu", None, "ap"])])
    # An update moves a row between partitions; a delete carries its key only.
    assert go(1, ("U", row(0, "eu", 10)), ("D", {"id": 4})) == [(0, "eu", 10), (1, "us", 1), (2, "eu", 2), (3, None, 3)]
    touched = spark.read.parquet(f"{root}/t/touched/_commit=1")
    assert sorted(r[0] for r in touched.collect()) == ["region=ap", "region=eu", "region=us"]
    assert go(2, ("U", row(3, None, 30))) == [(0, "eu", 10), (1, "us", 1), (2, "eu", 2), (3, None, 30)]
    assert rows(tables.read_versions(spark, root, spec, as_of=0), spec)[0] == (0, "us", 0)
    assert rows(tables.read_versions(spark, root, spec, as_of=1), spec)[3] == (3, None, 3)


def test_progress(spark):
    root = work_dir(spark, "t")
    assert progress.load_progress(spark, root, "p") == progress.EMPTY
    for i, lsn in enumerate((5, 9)):
        progress.save_progress(spark, root, "p", {"lsn": lsn}, at=NOW + timedelta(seconds=i))
    progress.save_progress(spark, root, "q", {"watermarks": {"public.t": "2025-01-01T00:00:00"}}, at=NOW)
    assert progress.load_progress(spark, root, "p")["lsn"] == 9
    assert progress.load_progress(spark, root, "q")["watermarks"] == {"public.t": "2025-01-01T00:00:00"}
    with pytest.raises(ValueError):
        progress.save_progress(spark, root, "p", {"nope": 1})


def test_poll_needs_key_and_watermark(spark):
    with pytest.raises(ValueError):
        pipeline.poll_cycle(spark, {}, [EVENTS], work_dir(spark, "t"))


def test_snapshot_selection():
    assert pending_tables(["a", "app.b", "c"], done=["public.a"], skip=["c"]) == ["app.b"]


def test_partition_dir(spark):
    paths = ["s3://w/t/data/region=us/x.parquet", "s3://w/t/data/a=1/b=2/x.parquet", "s3://w/t/data/x.parquet", "s3://w/x"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(partition_dir(F.col("p"))).collect()] == ["region=us", "a=1/b=2", "", ""]


def test_stream_gate_reports_expired_transactions(spark):
    """Transaction 1 commits, 2 never does and comes out unmatched once time has passed. Transaction 4 is far behind
    the newest row when it and its COMMIT arrive: it is committed, neither expired nor lost."""
    root = work_dir(spark, "t")

    def moved(rows, **by):
        return [r[:5] + (r[5] + timedelta(**by),) + r[6:] for r in rows]

    first = [*one_tx(EVENTS, 1, 1), *moved([control("COMMIT", 1, 150)], minutes=1), *moved(one_tx(EVENTS, 2, 2), minutes=2)]
    later = moved([*one_tx(EVENTS, 3, 3), control("COMMIT", 3, 350)], hours=9)
    late = [*one_tx(EVENTS, 4, 4), control("COMMIT", 4, 450)]
    for part in (first, later, late):
        feed(spark, part).write.mode("append").parquet(root + "/in")
        run_gate(read_feed(spark, root + "/in"), root + "/out", root + "/ck", "1 hour").awaitTermination()
    got = sorted((r.xid, r.commit_lsn) for r in read_gated(spark, root + "/out").collect())
    assert got == [(1, 150), (2, None), (3, 350), (4, 450)]
    assert FEED_SCHEMA["xid"].dataType == T.LongType()


def test_files_keep_field_ids(spark):
    import glob

    import pyarrow.parquet as pq

    ev = work_dir(spark, "t")
    pipeline.feed_batch(feed(spark, [*one_tx(EVENTS, 1, 1), control("COMMIT", 1, 199)]), 0, [EVENTS], ev)
    path = glob.glob(ev.removeprefix("file:") + "/counted_events/_commit=0/**/*.parquet", recursive=True)[0]
    ids = {f.name: int(f.metadata[b"PARQUET:field_id"]) for f in pq.read_schema(path)}
    assert ids == {"_op": 1, "_lsn": 2, "_ts": 3, "_seq": 4, "_unchanged_cols": 5, "id": 6, "value": 7}


def test_schema_changes_in_the_stream(spark):
    """Changes arrive between rows, in the middle of an open transaction and of a batch."""
    spec = TableSpec.of("public.t", [("id", "integer", False), ("v", "integer"), ("note", "text")], pk=["id"])
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")

    def change(lsn, **kw):
        return (spec.name, "SCHEMA_CHANGE", 0, lsn, lsn, NOW, NOW, None, SchemaChange(**kw).to_map(), None)

    def row(op, xid, pos, unchanged=(), **values):
        return dml(spec, op, {k: str(v) for k, v in values.items()}, unchanged, xid=xid, pos=pos)

    batches = [
        [row("I", 1, 1, id=1, v=1, note="old"), row("I", 2, 2, id=2, v=2, note="old"), control("COMMIT", 1, 3)],
        # Transaction 2 is still open when the column is dropped, comes back with a new id, and v widens.
        [change(5, dropped=("note",), retyped=(("v", "bigint"),)), row("I", 3, 6, id=3, v=3000000000),
         change(7, added=(("note", "text"), ("score", "integer"))), row("I", 3, 8, id=4, v=4, note="new", score=40),
         control("COMMIT", 3, 9)],
        [control("COMMIT", 2, 10), row("U", 4, 11, id=1, v=10, note="new", score=100), control("COMMIT", 4, 12)],
        [row("U", 5, 13, ["note"], id=4, v=44, score=41), control("COMMIT", 5, 14)],
    ]
    for i, b in enumerate(batches):
        for _ in range(2 if i == 1 else 1):  # a repeated batch must not apply its changes twice
            pipeline.feed_batch(feed(spark, b), i, [spec], ev)
        pipeline.materialize(spark, [spec], ev, tb)
    from millrace.sinks import schemas

    now, = schemas.latest(spark, ev, [spec])
    assert now.columns == ["id", "v", "note", "score"] and now.field_id("note") == 4
    assert rows(tables.read_state(spark, tb, now), now) == [
        (1, 10, "new", 100), (2, 2, None, None), (3, 3000000000, None, None), (4, 44, "new", 41)]


def test_reads_list_only_the_commits_wanted(spark):
    root = work_dir(spark, "t")
    for i in range(6):
        event_sink.append_events(event_rows(spark, i), EVENTS, root, i)
    assert len(event_sink.read_events(spark, root, EVENTS).inputFiles()) >= 6
    one = event_sink.read_events(spark, root, EVENTS, after=4)
    assert {f.split("_commit=")[1].split("/")[0] for f in one.inputFiles()} == {"5"}
    assert one.count() == 2


def event_rows(spark, i):
    from millrace.operators.envelope import to_events

    return to_events(feed(spark, one_tx(EVENTS, 0, 10 * i + 1, 10 * i + 2)), EVENTS)


def test_a_published_commit_is_never_replaced(spark):
    root = work_dir(spark, "t")
    event_sink.append_events(event_rows(spark, 0), EVENTS, root, 0)
    with pytest.raises(ValueError, match="published"):
        commits.publish(spark, root, 0, {"x": "append"})
    event_sink.append_events(event_rows(spark, 1), EVENTS, root, 0)  # the same batch: left as it is
    assert sorted(r.id for r in event_sink.read_events(spark, root, EVENTS).collect()) == [1, 2]


def test_a_duplicate_commit_counts_once(spark):
    root = work_dir(spark, "t")
    end = control("COMMIT", 1, 199)
    pipeline.feed_batch(feed(spark, [*one_tx(EVENTS, 1, 1), end, end]), 0, [EVENTS], root)
    assert count_events(spark, root) == 1


def test_equal_lake_names_are_refused():
    from millrace.spec import validate

    with pytest.raises(ValueError, match="taken by public.orders"):
        validate([TableSpec.of("public.orders", [("id", "bigint", False)], pk=["id"]),
                  TableSpec.of("app.orders", [("id", "bigint", False)], pk=["id"])])


def test_materializer_may_start_first(spark):
    root = work_dir(spark, "t")
    pipeline.run_materializer(spark, [EVENTS], root + "/ev", root + "/tb", root + "/ck").awaitTermination()
    pipeline.feed_batch(feed(spark, [*one_tx(EVENTS, 1, 1), control("COMMIT", 1, 199)]), 0, [EVENTS], root + "/ev")
    pipeline.run_materializer(spark, [EVENTS], root + "/ev", root + "/tb", root + "/ck").awaitTermination()
    assert tables.read_state(spark, root + "/tb", EVENTS).count() == 1


def test_polls_do_not_depend_on_the_drivers_zone(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        spec = TableSpec.of("public.p", [("id", "bigint"), ("at", "timestamptz"), ("n", "bigint")], pk=["id"], watermark="at")
        root = work_dir(spark, "t")
        rows = "select * from values (1L, timestamp'2025-01-01 10:00:00Z', 1L), (cast(null as bigint), timestamp'2025-01-01 09:00:00Z', 1L) t(id, at, n)"
        more = rows.replace(" t(id", ", (2L, timestamp'2025-01-01 12:00:00Z', 1L), (cast(null as bigint), timestamp'2025-01-01 11:00:00Z', 2L) t(id")
        done = [pipeline.poll_cycle(spark, {spec.name: spark.sql(q)}, [spec], root, lag=lag)
                for q, lag in ((rows, None), (more, None), (more, "3 hours"), (more, "3 hours"))]
        assert done == [0, 1, None, None]
        got = {(r.id, r.n) for r in tables.read_state(spark, root, spec).collect()}
        assert got == {(1, 1), (2, 1), (None, 2)}
    finally:
        monkeypatch.undo()
        time.tzset()


def test_whole_number_watermarks_poll(spark):
    spec = TableSpec.of("public.n", [("id", "bigint", False), ("v", "bigint")], pk=["id"], watermark="v")
    root = work_dir(spark, "t")
    polls = [spark.range(n).select("id", F.col("id").alias("v")) for n in (3, 5, 5)]
    assert [pipeline.poll_cycle(spark, {spec.name: p}, [spec], root) for p in polls] == [0, 1, None]
    assert tables.read_state(spark, root, spec).count() == 5


def test_a_changed_key_keeps_unchanged_columns(spark):
    spec = TableSpec.of("public.k", [("id", "bigint", False), ("big", "text"), ("n", "bigint")], pk=["id"], maybe_unchanged=("big",))
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    pipeline.feed_batch(feed(spark, [dml(spec, "I", {"id": "1", "big": "long", "n": "1"}, pos=1)]), 0, [spec], ev)
    moved = dml(spec, "U", {"id": "2", "n": "2"}, unchanged=["big"], before={"id": "1", "big": "long", "n": "1"}, pos=2)
    pipeline.feed_batch(feed(spark, [moved]), 1, [spec], ev)
    pipeline.materialize(spark, [spec], ev, tb)
    assert rows(tables.read_state(spark, tb, spec), spec) == [(2, "long", 2)]


def test_snapshot_rows_after_a_schema_change_keep_the_new_column(spark):
    spec = TableSpec.of("public.s", [("id", "bigint", False)], pk=["id"])
    root = work_dir(spark, "t")
    change = (spec.name, "SCHEMA_CHANGE", 0, 50, 50, NOW, NOW, None, SchemaChange(added=(("extra", "text"),)).to_map(), None)
    pipeline.feed_batch(feed(spark, [change]), 0, [spec], root)
    source = spark.sql("select 1L as id, 'x' as extra")
    assert pipeline.run_snapshot(spark, {"public.s": source}, [spec], root, F.lit(NOW), "p") == ["public.s"]
    from millrace.sinks import schemas

    now = schemas.latest(spark, root, [spec])[0]
    assert [r.extra for r in event_sink.read_events(spark, root, now).collect()] == ["x"]


def test_paths_escape_values(spark):
    from millrace.functions.transforms import parse_partition_path, partition_fields, partition_path

    spec = TableSpec.of("public.e", [("id", "bigint", False), ("a", "text")], pk=["id"], partition=("a",))
    fields = partition_fields(spec.partition, spec)
    values = ["a/b=c", "50%", "__null__", None, "%2F", "_x"]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    got = df.select("a", partition_path(fields).alias("p")).select("a", "p", parse_partition_path(F.col("p"), fields)["a"].alias("b")).collect()
    assert [r.b for r in got] == values and len({r.p for r in got}) == len(values)
