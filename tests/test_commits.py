"""Write-once commits, the log's upkeep, key lookups, open transactions, registry, flush limits."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.fold import as_folded, fold
from millrace.session import work_dir
from millrace.sinks import commits, events as event_sink, files, progress, registry, schemas, tables
from millrace.sources.feed import read_feed
from millrace.spec import SchemaChange, TableSpec
from millrace.streaming import pipeline
from tests.feeds import NOW, control, dml, feed, numbered, rows

T = TableSpec.of("public.t", [("id", "bigint", False), ("v", "integer"), ("note", "text")], pk=["id"], maybe_unchanged=("note",))
OTHER = TableSpec.of("public.other", [("id", "bigint", False), ("v", "integer")], pk=["id"])


def put(spark, root, n, lo, hi, **kw):
    return commits.commit_tables(spark, root, n, {"x": spark.range(lo, hi)}, **kw)


def read(spark, root, **kw):
    return sorted(r.id for r in commits.read_table(spark, root, "x", spark.range(1).schema, **kw).collect())


def one(spec, xid, pos, **values):
    return dml(spec, "I", {k: str(v) for k, v in values.items()}, xid=xid, pos=pos)


# -- write once --------------------------------------------------------------


def test_a_refused_commit_changes_nothing(spark):
    root = work_dir(spark, "t")
    put(spark, root, 0, 0, 10)
    with pytest.raises(ValueError, match="published"):
        put(spark, root, 0, 100, 103)
    assert read(spark, root) == list(range(10))
    ev = event_sink
    rows0 = T.events_schema()
    made = spark.createDataFrame([("I", 1, NOW, 1, None, 7, 7, "n")], rows0)
    with pytest.raises(ValueError, match="published"):
        ev.append_events(made, T, root, 0)
    assert read(spark, root) == list(range(10)) and ev.read_events(spark, root, T).count() == 0
    spec = TableSpec.of("public.p", [("id", "bigint", False), ("region", "text")], pk=["id"], partition=("region",))
    change = as_folded(spark.createDataFrame([(1, "a")], "id long, region string"), spec)
    with pytest.raises(ValueError, match="published"):
        tables.merge_table(change, spec, root, 0)
    tables.merge_table(change, spec, root, 1, source="m")
    tables.merge_table(as_folded(spark.createDataFrame([(1, "b")], "id long, region string"), spec), spec, root, 2, source="m")
    assert [tuple(r) for r in tables.read_versions(spark, root, spec).collect()] == [(1, "a")]


def test_a_source_that_is_there_is_left_as_it_is(spark):
    root = work_dir(spark, "t")
    assert put(spark, root, 0, 0, 3, source="s:0") == 0
    assert put(spark, root, 0, 5, 9, source="s:0") == 0 and put(spark, root, 7, 5, 9, source="s:0") == 0
    assert put(spark, root, None, 3, 5, source="s:1") == 1
    assert read(spark, root) == [0, 1, 2, 3, 4]


def test_attempts_have_their_own_folders(spark):
    """A write that was never published, before or after, is not seen and does not disturb."""
    root = work_dir(spark, "t")
    commits.write_part(spark.range(50, 60), root, "x", 0)
    put(spark, root, 0, 0, 4)
    commits.write_part(spark.range(70, 80), root, "x", 0)
    assert read(spark, root) == [0, 1, 2, 3]
    assert len(files.names(spark, f"{root}/x/_commit=0")) == 3


def test_two_writers_of_one_number(spark, monkeypatch):
    """Both pass the check; all readers take the same one, and the other is told."""
    root = work_dir(spark, "t")
    with monkeypatch.context() as m:
        m.setattr(commits, "new_attempt", lambda: "a1")
        put(spark, root, 0, 0, 3)
    part = commits.write_part(spark.range(9), root, "x", 0, attempt="a2")
    with monkeypatch.context() as m:
        m.setattr(commits, "_whole", lambda *a: False)
        with pytest.raises(commits.Published, match="same time"):
            commits.publish(spark, root, 0, {"x": "append"}, attempt=part.attempt)
    assert read(spark, root) == [0, 1, 2]
    assert commits.log(spark, root).count() == 1


# -- roll-up and expiry ------------------------------------------------------


def test_the_log_is_rolled_up(spark, monkeypatch):
    monkeypatch.setattr(commits, "ROLL_EVERY", 3)
    root = work_dir(spark, "t")
    for n in range(14):
        put(spark, root, None, n, n + 1, source=f"s:{n}", mark=n)
    rolled, fresh, covered = commits._log_paths(spark, root)
    assert len(rolled) == 1 and covered >= 8 and len(rolled) + len(fresh) <= 2 * 3 + 1
    assert len(files.names(spark, commits.log_path(root))) < 12
    log = commits.load(spark, root)
    assert log.top == 13 and log.mark == 13 and log.find("s:3") == 3
    assert read(spark, root) == list(range(14)) and read(spark, root, after=10) == [11, 12, 13]
    assert read(spark, root, upto=2) == [0, 1, 2]
    assert commits.log(spark, root).count() == 14 and commits.history(spark, root).filter("previous is null").count() == 1
    with pytest.raises(ValueError, match="published"):
        put(spark, root, 2, 0, 1)


def changed(spark, spec, *ops):
    from millrace.operators.envelope import to_events

    ops = [(op, {k: None if v is None else str(v) for k, v in row.items()}) for op, row in ops]
    return fold(to_events(feed(spark, numbered(spec, ops)), spec), spec).persist()


def delta(spark, root, spec, *ops, slots=1):
    folded = changed(spark, spec, *ops)
    writes = tables.delta_writes(folded, spec, slots=slots)
    return commits.commit_tables(spark, root, None, writes, kind=tables.delta_kinds(spec), partition_by=tables.partition_map(spec, slots),
                                 details={t: {"slots": slots} for t in writes})


def test_expired_commits_are_gone(spark):
    root = work_dir(spark, "t")
    for n in range(4):
        delta(spark, root, T, ("I", {"id": n, "v": n, "note": "x"}), ("D", {"id": n - 1}))
    base = tables.compact(spark, root, T)
    delta(spark, root, T, ("I", {"id": 9, "v": 9, "note": "y"}))
    now, then = (rows(tables.read_state(spark, root, T, as_of=c), T) for c in (None, base))
    commits.write_part(spark.range(3), root, tables.data_name(T), 2)  # of an attempt that died
    assert commits.expire(spark, root, base) == 12
    assert rows(tables.read_state(spark, root, T), T) == now
    assert rows(tables.read_state(spark, root, T, as_of=base), T) == then
    with pytest.raises(ValueError, match="expired"):
        tables.read_state(spark, root, T, as_of=base - 1)
    assert commits._numbers(spark, f"{root}/{tables.data_name(T)}", "_commit") == [base, base + 1]
    assert commits.expire(spark, root, base) == 0
    delta(spark, root, T, ("D", {"id": 9}))
    assert len(rows(tables.read_state(spark, root, T), T)) == len(now) - 1


def test_expiry_of_append_only_tables_goes_by_number(spark):
    root = work_dir(spark, "t")
    for n in range(4):
        put(spark, root, n, n, n + 1)
    assert commits.expire(spark, root, 2) == 0 and read(spark, root) == [0, 1, 2, 3]
    assert commits.expire(spark, root, 2, append_only=["x"]) == 2 and read(spark, root) == [2, 3]


def test_progress_is_rolled_up(spark, monkeypatch):
    monkeypatch.setattr(progress, "ROLL_EVERY", 3)
    root = work_dir(spark, "t")
    for i in range(11):
        progress.save_progress(spark, root, f"p{i % 2}", {"lsn": i})
    assert [progress.load_progress(spark, root, p)["lsn"] for p in ("p0", "p1", "p2")] == [10, 9, 0]
    assert len(progress._saves(spark, root)) <= 2 * 3


# -- key lookups -------------------------------------------------------------


@pytest.mark.default_conf
def test_a_lookup_of_a_few_keys_opens_a_few_files(spark, monkeypatch):
    monkeypatch.setattr(tables, "SLOT_ROWS", 50)
    root = work_dir(spark, "t")
    many = spark.range(2000).select("id", F.col("id").cast("int").alias("v"), F.lit("n").alias("note"))
    whole = as_folded(many, T).persist()
    commits.commit_tables(spark, root, 0, tables.delta_writes(whole, T, slots=1), kind=tables.delta_kinds(T))
    tables.compact(spark, root, T)
    for n in range(6):
        delta(spark, root, T, *[("I", {"id": 3000 + 10 * n + i, "v": n, "note": "later"}) for i in range(3)])
    log = commits.load(spark, root)
    assert log.entries(tables.data_name(T))[1]["slots"] == 40
    keys = spark.createDataFrame([(i,) for i in (5, 77, 1500, 3021, 99999)], "id long")
    data, deletes = tables.read_keys(spark, root, T, keys, log)
    all_files = len(tables.read_parts(spark, root, T, log=log)[0].inputFiles())
    assert all_files >= 40 and len(data.inputFiles()) <= 7 and len(deletes.inputFiles()) <= 2
    assert {r.id for r in data.join(keys, "id").collect()} == {5, 77, 1500, 3021}
    monkeypatch.setattr(tables, "FEW_KEYS", 2)
    assert len(tables.read_keys(spark, root, T, keys, log)[0].inputFiles()) == all_files


def test_lookups_find_every_key_wherever_it_lies(spark, monkeypatch):
    """Slots, partitions, deltas with and without index, deletes: the pruned read gives what the whole table gives."""
    monkeypatch.setattr(tables, "SLOT_ROWS", 7)
    spec = TableSpec.of("public.q", [("a", "integer"), ("b", "text", False), ("region", "text"), ("v", "integer")], pk=["a", "b"],
                        partition=("region",))
    root = work_dir(spark, "t")
    row = lambda i, r, v: {"a": None if i % 7 == 0 else i, "b": f"k{i}", "region": r, "v": v}
    delta(spark, root, spec, *[("I", row(i, "eu" if i % 2 else None, i)) for i in range(60)], slots=5)
    tables.compact(spark, root, spec)
    delta(spark, root, spec, *[("U", row(i, "us", -i)) for i in range(0, 60, 9)], *[("D", row(i, None, 0)) for i in range(1, 60, 11)], slots=3)
    plain = changed(spark, spec, ("I", row(100, "ap", 1)), ("D", row(14, None, 0)))
    commits.commit_tables(spark, root, None, tables.delta_writes(plain, spec), kind="delta", partition_by=tables.partition_map(spec))
    from millrace.operators import mor
    from millrace.operators.mor import keys_match

    log = commits.load(spark, root)
    state = {(r.b, r.region, r.v) for r in tables.read_state(spark, root, spec).collect()}
    for i in (0, 1, 9, 14, 100, 500):
        keys = spark.createDataFrame([(row(i, None, 0)["a"], f"k{i}")], "a int, b string")
        data, deletes = (df.alias("f").join(keys.alias("b"), keys_match(spec.pk, spec.nullable_keys), "left_semi")
                         for df in tables.read_keys(spark, root, spec, keys, log))
        got = {(r.b, r.region, r.v) for r in mor.scan(data, deletes, spec.pk, nullable=spec.nullable_keys).collect()}
        assert got == {x for x in state if x[0] == f"k{i}"}, i


def test_key_hashes_survive_widening(spark):
    wide = T.evolve(SchemaChange(retyped=(("v", "bigint"),)))
    keyed = [TableSpec.of("public.w", [("k", t, False)], pk=["k"]) for t in ("integer", "bigint")]
    df = spark.range(5).select(F.col("id").cast("int").alias("k"))
    a = [r[0] for r in df.select(tables.key_hash(keyed[0])).collect()]
    assert a == [r[0] for r in df.select(F.col("k").cast("bigint")).select(tables.key_hash(keyed[1])).collect()] and wide.columns == T.columns
    assert [tables.slot_of(h, 9) for h in (-(1 << 31), 0, (1 << 31) - 1)] == [0, 4, 8]


def test_unchanged_columns_come_through_the_pruned_lookup(spark, monkeypatch):
    monkeypatch.setattr(tables, "SLOT_ROWS", 5)
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    pipeline.feed_batch(feed(spark, [one(T, 0, i, id=i, v=i, note=f"n{i}") for i in range(30)]), 0, [T], ev)
    pipeline.materialize(spark, [T], ev, tb)
    tables.compact(spark, tb, T)
    late = [dml(T, "U", {"id": str(i), "v": "-1"}, unchanged=["note"], pos=100 + i) for i in (3, 17, 88)]
    pipeline.feed_batch(feed(spark, late), 1, [T], ev)
    pipeline.materialize(spark, [T], ev, tb)
    got = {r.id: (r.v, r.note) for r in tables.read_state(spark, tb, T).collect()}
    assert got[3] == (-1, "n3") and got[17] == (-1, "n17") and got[88] == (-1, None) and got[4] == (4, "n4")


# -- open transactions -------------------------------------------------------


def test_a_bulk_transaction_is_written_once(spark):
    root = work_dir(spark, "t")
    for n in range(5):
        batch = [one(T, 7, 1000 * n + i, id=1000 * n + i, v=1, note="bulk") for i in range(20)]
        batch += [one(T, 100 + n, 1000 * n + 500, id=10**6 + n, v=2, note="own"), control("COMMIT", 100 + n, 1000 * n + 501)]
        pipeline.feed_batch(feed(spark, batch), n, [T], root)
        assert event_sink.read_events(spark, root, T).count() == n + 1
        assert pipeline.open_rows(spark, root).count() == 20 * (n + 1)
    log = commits.load(spark, root)
    written = commits.read_table(spark, root, pipeline.OPEN_ROWS, pipeline.FEED_SCHEMA, log=log).groupBy("_commit").count().collect()
    assert {r["_commit"]: r["count"] for r in written} == {n: 20 for n in range(5)}
    pipeline.feed_batch(feed(spark, [control("COMMIT", 7, 9000), one(T, 8, 9001, id=5, v=5, note="x")]), 5, [T], root)
    assert event_sink.read_events(spark, root, T).count() == 105
    assert [r.xid for r in pipeline.open_rows(spark, root).collect()] == [8]
    assert commits.load(spark, root).entries(pipeline.OPEN_ROWS)[-1]["_commit"] == 5
    pipeline.feed_batch(feed(spark, [control("COMMIT", 8, 9100)]), 6, [T], root)
    assert event_sink.read_events(spark, root, T).count() == 106 and pipeline.open_rows(spark, root).count() == 0


def test_events_expire_and_waiting_rows_stay(spark):
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    for n in range(3):  # transaction 7 stays open, the others end in the batch after their rows
        batch = [one(T, 10 + n, 100 * n + 1, id=n, v=n, note="x")] + ([one(T, 7, 2, id=70, v=7, note="open")] if n == 0 else [])
        batch += [control("COMMIT", 9 + n, 100 * n + 3)] if n else []
        pipeline.feed_batch(feed(spark, batch), n, [T], ev)
    pipeline.materialize(spark, [T], ev, tb)
    assert pipeline.expire_events(spark, ev, [T], 2) == 4  # events of commit 1, waiting rows of 1, lists of 0 and 1
    assert sorted(r.after["id"] for r in pipeline.open_rows(spark, ev).collect()) == ["2", "70"]
    pipeline.feed_batch(feed(spark, [control("COMMIT", 7, 900), control("COMMIT", 12, 901)]), 3, [T], ev)
    pipeline.materialize(spark, [T], ev, tb)
    assert [r[0] for r in rows(tables.read_state(spark, tb, T), T)] == [0, 1, 2, 70]


def test_only_buckets_of_committed_transactions_are_read(spark):
    root = work_dir(spark, "t")
    for n in range(3):
        pipeline.feed_batch(feed(spark, [one(T, 10 * n + k, 100 * n + k, id=10 * n + k, v=1, note="w") for k in range(1, 9)]), n, [T], root)
    log = commits.load(spark, root)
    mine = spark.createDataFrame([(13,)], "xid long")
    found = pipeline.waiting_rows(spark, root, log, mine)
    paths = {f.partition("_attempt")[0].rpartition("_commit=")[2].strip("/") for f in found.inputFiles()}
    assert paths == {"1"} and 13 in {r.xid for r in found.collect()} and found.count() < 8
    assert pipeline.waiting_rows(spark, root, log, spark.createDataFrame([(999,)], "xid long")) is None


def test_an_empty_batch_is_known_when_it_comes_again(spark):
    root = work_dir(spark, "t")
    assert pipeline.feed_batch(feed(spark, []), 0, [T], root) == pipeline.feed_batch(feed(spark, []), 0, [T], root) == 0
    assert pipeline.materialize(spark, [T], root, work_dir(spark, "t")) is not None


def test_late_rows_of_committed_transactions_are_not_expired(spark):
    from datetime import timedelta

    from millrace.streaming.gate import gate_batch, read_gated

    root = work_dir(spark, "t")
    moved = lambda r, **by: r[:5] + (r[5] + timedelta(**by),) + r[6:]
    gate_batch(feed(spark, [one(T, 1, 1, id=1, v=1, note="a"), control("COMMIT", 1, 2)]), 0, root, "s")
    gate_batch(feed(spark, [moved(one(T, 2, 3, id=2, v=1, note="a"), hours=5), moved(control("COMMIT", 2, 4), hours=5)]), 1, root, "s")
    gate_batch(feed(spark, [one(T, 1, 5, id=3, v=1, note="late"), one(T, 9, 6, id=4, v=1, note="never")]), 2, root, "s")
    got = sorted((r.xid, r.pos, r.commit_lsn) for r in read_gated(spark, root).collect())
    assert got == [(1, 1, 2), (1, 5, 2), (2, 3, 4), (9, 6, None)]


# -- registry, versions, before-images ---------------------------------------


def test_tables_come_and_go_while_the_feed_runs(spark):
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    both = lambda n: feed(spark, [one(T, 0, 10 * n + 1, id=n, v=n, note="t"), one(OTHER, 0, 10 * n + 2, id=n, v=n)])
    pipeline.feed_batch(both(0), 0, [T], ev)
    there = spark.createDataFrame([(0, 0), (50, 50)], "id long, v int")
    registry.add_table(spark, ev, [T], OTHER, there, F.lit(NOW))
    with pytest.raises(ValueError, match="tracked already"):
        registry.add_table(spark, ev, [T], OTHER)
    pipeline.feed_batch(both(1), 1, [T], ev)
    pipeline.materialize(spark, [T], ev, tb)
    assert rows(tables.read_state(spark, tb, OTHER), OTHER) == [(0, 0), (1, 1), (50, 50)]
    registry.remove_table(spark, ev, [T], "other")
    pipeline.feed_batch(both(2), 2, [T], ev)
    pipeline.materialize(spark, [T], ev, tb)
    assert [r[0] for r in rows(tables.read_state(spark, tb, T), T)] == [0, 1, 2]
    assert rows(tables.read_state(spark, tb, OTHER), OTHER) == [(0, 0), (1, 1), (50, 50)]
    with pytest.raises(ValueError, match="not tracked"):
        registry.remove_table(spark, ev, [T], "other")
    log = commits.load(spark, ev)
    assert [s.name for s in registry.current([T], log)] == ["public.t"]
    assert registry.current([T], log.upto(2))[1] == OTHER


def test_commits_say_which_schema_they_were_written_under(spark):
    ev = work_dir(spark, "t")
    change = (T.name, "SCHEMA_CHANGE", 0, 5, 5, NOW, NOW, None, SchemaChange(added=(("extra", "text"),)).to_map(), None)
    pipeline.feed_batch(feed(spark, [one(T, 0, 1, id=1, v=1, note="a")]), 0, [T], ev)
    pipeline.feed_batch(feed(spark, [change, one(T, 0, 6, id=2, v=2, note="b", extra="e")]), 1, [T], ev)
    listed = commits.history(spark, ev).filter(F.col("table") == T.events_name).orderBy("_commit").collect()
    assert [(r["_commit"], r["schema_id"], r["previous"]) for r in listed] == [(0, 0, None), (1, 1, 0)]
    assert [schemas.at_commit(spark, ev, T, T.events_name, n).columns[3:] for n in (0, 1)] == [[], ["extra"]]


def test_complete_before_images_leave_nothing_to_look_up(spark, monkeypatch):
    from dataclasses import replace

    full = replace(T, full_before_images=True)
    ev, tb = work_dir(spark, "t"), work_dir(spark, "t")
    pipeline.feed_batch(feed(spark, [one(full, 0, 1, id=1, v=1, note="kept")]), 0, [full], ev)
    pipeline.materialize(spark, [full], ev, tb)
    update = dml(full, "U", {"id": "1", "v": "2"}, unchanged=["note"], before={"id": "1", "v": "1", "note": "kept"}, pos=2)
    moved = dml(full, "U", {"id": "5", "v": "3"}, unchanged=["note"], before={"id": "1", "v": "2", "note": "kept"}, pos=3)
    monkeypatch.setattr(tables, "read_keys", lambda *a: pytest.fail("the table must not be read"))
    for n, row in enumerate((update, moved), 1):
        pipeline.feed_batch(feed(spark, [row]), n, [full], ev)
        pipeline.materialize(spark, [full], ev, tb)
        assert rows(tables.read_state(spark, tb, full), full) == [((1, 2) if n == 1 else (5, 3)) + ("kept",)]


def test_replica_identity_is_discovered(spark):
    from millrace.sources.relational import columns_query, discover

    cols = "column_name string, data_type string, nullable boolean, ord int, key_ord int, full_before_images boolean"
    found = [spark.createDataFrame([("id", "bigint", False, 1, 1, full), ("v", "text", True, 2, None, full)], cols) for full in (True, False, None)]
    assert [discover(f, "t").full_before_images for f in found] == [True, False, False]
    assert "relreplident" in columns_query("t")


# -- flushes, files, snapshots -----------------------------------------------


def test_a_batch_is_flushed_by_rows_and_by_bytes(spark):
    batch = feed(spark, [one(T, 0, i, id=i, v=i, note="n" * 50) for i in range(100)])
    by_rows, by_bytes = work_dir(spark, "t"), work_dir(spark, "t")
    for _ in range(2):  # the second time changes nothing
        pipeline.flush_batch(batch, 0, [T], by_rows, max_rows=30)
        pipeline.flush_batch(batch, 0, [T], by_bytes, max_bytes=6000)
    for root, most in ((by_rows, 30), (by_bytes, 60)):
        per = [r[1] for r in event_sink.read_events(spark, root, T).groupBy("_commit").count().collect()]
        assert sum(per) == 100 and max(per) <= most and 3 <= len(per) <= 20


def test_a_flush_that_died_goes_on_behind_its_last_commit(spark, monkeypatch):
    root = work_dir(spark, "t")
    batch = feed(spark, [one(T, 0, i, id=i, v=i, note="n") for i in range(100)])
    real, count = pipeline.feed_batch, []

    def dies(*a, **k):
        count.append(1)
        if len(count) == 3:
            raise OSError("lost")
        return real(*a, **k)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "feed_batch", dies)
        with pytest.raises(OSError):
            pipeline.flush_batch(batch, 0, [T], root, max_rows=30)
    pipeline.flush_batch(batch, 0, [T], root, max_rows=25)  # cut elsewhere now
    got = [r.id for r in event_sink.read_events(spark, root, T).collect()]
    assert sorted(got) == list(range(100))


def test_flush_limits_in_a_stream(spark):
    root = work_dir(spark, "t")
    feed(spark, [one(T, 1, i, id=i, v=i, note="n") for i in range(60)] + [control("COMMIT", 1, 99)]).write.parquet(f"{root}/in")
    pipeline.run_feed(read_feed(spark, f"{root}/in"), [T], f"{root}/ev", f"{root}/ck", flush_rows=20).awaitTermination()
    assert event_sink.read_events(spark, f"{root}/ev", T).count() == 60 and commits.last_commit(spark, f"{root}/ev") >= 3


def test_a_snapshot_reads_all_tables_as_of_one_version(spark):
    lake, ev = work_dir(spark, "t"), work_dir(spark, "t")
    a, b = (TableSpec.of(f"public.{n}", [("id", "bigint", False), ("v", "bigint")], pk=["id"]) for n in "ab")

    def write(value):
        made = {}
        for s in (a, b):
            made |= tables.delta_writes(as_folded(spark.range(3).select("id", F.lit(value).cast("bigint").alias("v")), s), s)
        commits.commit_tables(spark, lake, None, made, kind="delta")

    write(1)
    source = pipeline.pinned_lake(spark, lake, [a, b])
    seen = []

    def read_and_change(name, version):
        seen.append(version)
        write(len(seen) + 1)
        if len(seen) == 2:
            raise OSError("lost")
        return source.read(name, version)

    from dataclasses import replace

    busy = replace(source, read=read_and_change)
    with pytest.raises(OSError):
        pipeline.run_snapshot(spark, busy, [a, b], ev, F.lit(NOW), "p")
    assert pipeline.run_snapshot(spark, busy, [a, b], ev, F.lit(NOW), "p") == ["public.b"]
    assert seen == [0, 0, 0]
    assert {r.v for s in (a, b) for r in event_sink.read_events(spark, ev, s).collect()} == {1}


def test_files_have_the_size_asked_for(spark):
    root = work_dir(spark, "t")
    df = spark.range(60_000).select("id", F.md5(F.col("id").cast("string")).alias("t")).persist()
    for n in range(2):
        commits.commit_tables(spark, root, n, {"x": df}, target_bytes={"x": 400_000})
    for p in commits.load(spark, root).parts("x"):
        per = [f.getLen() for f in files._at(spark, p.path(f"{root}/x"))[0].listStatus(files._at(spark, p.path(f"{root}/x"))[1])
               if f.getPath().getName().startswith("part-")]
        assert len(per) >= 4 and all(300_000 <= x <= 500_000 for x in sorted(per)[1:])
    entry = commits.load(spark, root).entries("x")[-1]
    assert entry["rows"] == 60_000 and entry["files"] >= 4 and entry["bytes"] > 10**6


# -- what one task takes ------------------------------------------------------

def by_task(n, tasks):
    """Rows that name the task which computed them."""
    from pyspark import TaskContext

    task = F.udf(lambda _: TaskContext.get().taskAttemptId() % 1_000_000, "int").asNondeterministic()
    return lambda spark: spark.range(0, n, 1, tasks).withColumn("v", task("id"))


def test_a_small_commit_is_one_file_of_many_tasks(spark):
    rows = by_task(400, 4)(spark)
    writes = tables.delta_writes(as_folded(rows, OTHER), OTHER, slots=1)
    assert all(df.rdd.getNumPartitions() == 1 for df in writes.values())
    data = writes[tables.data_name(OTHER)].collect()
    assert len(data) == 400 and len({r.v for r in data}) == 4


def test_the_list_of_open_transactions_comes_from_many_tasks(spark, monkeypatch):
    seen = {}

    def commit(spark, root, number, writes, **kw):
        seen.update(writes)
        return number

    monkeypatch.setattr(commits, "commit_tables", commit)
    waiting = [one(T, x, x * 10, id=x, v=x) for x in range(1, 20)]
    pipeline.feed_batch(feed(spark, waiting), 0, [T], work_dir(spark, "t"))
    assert sorted(r.xid for r in seen[pipeline.OPEN_XIDS].collect()) == list(range(1, 20))
    assert "Coalesce 1" not in seen[pipeline.OPEN_XIDS]._jdf.queryExecution().toString()


def test_a_probe_is_no_reading_of_all_rows_by_one_task(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(commits.files, "remove", lambda _, path: kept.append(path))
    commits.sized(by_task(400, 4)(spark), work_dir(spark, "t"), "x", commits.Log([]), 1 << 20)
    probe = spark.read.parquet(kept[0]).collect()
    assert len(probe) == 400 and len({r.v for r in probe}) == 4


def test_measured_files_are_no_larger_than_a_task_should_read(spark, sf, monkeypatch):
    """A sixth of a large table is too much for one file."""
    from millrace.plans import engine

    monkeypatch.setattr(engine, "K7_FILE", 10_000)
    written = []
    real = commits.commit_tables
    monkeypatch.setattr(commits, "commit_tables", lambda *a, **kw: written.append(kw.get("target_bytes")) or real(*a, **kw))
    got = engine.k7_measured(spark, sf).collect()
    assert written[1:] == [{"lineitem": 10_000}] * 2 and len({r.rows for r in got}) == 1


def test_files_are_summed_up_in_one_call(spark, monkeypatch):
    at = work_dir(spark, "t")
    spark.range(200).withColumn("_p", F.col("id") % 100).coalesce(1).write.partitionBy("_p").parquet(at)
    client = spark._jvm._gateway_client
    calls, real = [], client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **kw: calls.append(1) or real(*a, **kw))
    n, total = files.size(spark, at)
    made = len(calls)
    monkeypatch.undo()
    assert n == 100 and total == spark.read.parquet(at).select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
    assert made < 150
