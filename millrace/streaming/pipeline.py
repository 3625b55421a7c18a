"""The three pipelines: feed -> events tables, events -> materialized tables, poll -> tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.apply import is_unresolved, resolve_parts, unresolved
from millrace.operators.envelope import dml_only, to_events, tracked
from millrace.operators.evolve import conform_ids
from millrace.operators.fold import as_folded, fold
from millrace.operators.latest import latest_per_key
from millrace.operators.spread import with_range
from millrace.operators.transactions import NO_XID, commits as commit_rows
from millrace.session import together
from millrace.sinks import commits, events as event_sink, progress, registry, schemas, tables
from millrace.sources.feed import FEED_SCHEMA
from millrace.operators.mor import COMMIT, keys_match, scan
from millrace.sources.poll import mark_of, poll
from millrace.sources.snapshot import Pinned, pending_tables, snapshot_scan
from millrace.spec import SchemaChange, TableSpec, materializable, qualified, validate

OPEN_ROWS, OPEN_XIDS = "open_transactions", "open_xids"
XID_BUCKET, XID_BUCKETS = "_xid_bucket", 16
XID_SCHEMA = T.StructType([T.StructField("xid", T.LongType()), T.StructField("at", T.LongType())])


# -- feed -> events ----------------------------------------------------------


def _bucket(xid: Column) -> Column:
    return F.pmod(F.xxhash64(xid), F.lit(XID_BUCKETS)).cast("int")


def open_xids(spark: SparkSession, root: str, log: commits.Log) -> DataFrame | None:
    """Open transactions and the commits that hold rows of theirs; None when there are none."""
    held = log.entries(OPEN_XIDS)
    if not held or held[-1]["note"] == "0":
        return None
    return commits.read_parts(spark, root, OPEN_XIDS, XID_SCHEMA, [commits.Part(held[-1][COMMIT], held[-1]["attempt"])]).select("xid", "at")


def waiting_rows(spark: SparkSession, root: str, log: commits.Log, xids: DataFrame) -> DataFrame | None:
    """Rows that wait for one of these transactions (rows ``xid``), or None. They are looked up in the list of open
    transactions; only the buckets of the commits that hold some of them are read."""
    listed = open_xids(spark, root, log)
    if listed is None:
        return None
    mine = listed.join(xids.select("xid").distinct(), "xid", "left_semi")
    places = mine.select("at", _bucket(F.col("xid")).alias(XID_BUCKET)).distinct().collect()
    if not places:
        return None
    there = {p.commit: p for p in log.parts(OPEN_ROWS)}
    schema = T.StructType([*FEED_SCHEMA.fields, T.StructField(XID_BUCKET, T.IntegerType())])
    rows = commits.read_parts(spark, root, OPEN_ROWS, schema, [there[c] for c in sorted({r["at"] for r in places})])
    hit = F.lit(False)
    for b in sorted({r[XID_BUCKET] for r in places}):
        at = sorted(r["at"] for r in places if r[XID_BUCKET] == b)
        hit = hit | ((F.col(XID_BUCKET) == b) & F.col(COMMIT).isin(at))
    # A transaction's rows all stand in the commits its list names, so the transaction alone decides from here on.
    return rows.filter(hit).select(*FEED_SCHEMA.names)


def open_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows of transactions that have not been committed yet."""
    log = commits.load(spark, root)
    listed = open_xids(spark, root, log)
    rows = None if listed is None else waiting_rows(spark, root, log, listed)
    if rows is None:
        return spark.createDataFrame([], FEED_SCHEMA)
    return rows.join(listed.select("xid").distinct(), "xid", "left_semi").select(*FEED_SCHEMA.names)


def expire_events(spark: SparkSession, root: str, specs: Sequence[TableSpec], before: int) -> int:
    """Remove events of commits before ``before``, which every materializer must have taken in, and the rows of
    transactions that are open no longer. Rows that still wait stay, however old, as do schema versions."""
    log = commits.load(spark, root)
    listed = open_xids(spark, root, log)
    waiting = set() if listed is None else {r["at"] for r in listed.select("at").distinct().collect()}
    names = [s.events_name for s in registry.current(specs, log)]
    return commits.expire(spark, root, before, names, {OPEN_ROWS: waiting})


def feed_batch(batch: DataFrame, batch_id: int | str, specs: Sequence[TableSpec], root: str,
               pipeline_id: str | None = None, stream: str = "feed", note: str | None = None) -> int | None:
    """One micro-batch: committed rows become events, open ones wait for their COMMIT.

    Its commit number comes from the log; (``stream``, ``batch_id``) says whether
    the batch is there already, so a new checkpoint on an old root goes on behind
    what is written, and a repeated batch changes nothing.

    Waiting rows are a table of the commit that brought them, in buckets by
    transaction, written once and never moved, so a transaction may stay open
    for any time and be of any size. What is carried from batch to batch is the
    list of open transactions and of the commits that hold their rows; a batch
    reads the buckets of the transactions it commits and no others. Tables are
    those of ``specs`` as changed by the registry of the log.
    """
    return commits.retry_commit(partial(_feed_batch, batch, batch_id, specs, root, pipeline_id, stream, note))


def _feed_batch(batch, batch_id, specs, root, pipeline_id, stream, note):
    spark = batch.sparkSession
    source = f"{stream}:{batch_id}"
    log = commits.load(spark, root)
    if (there := log.find(source)) is not None:
        return there
    specs = registry.current(specs, log)
    number = log.top + 1
    mine = tracked(batch, [s.name for s in specs]).select(*FEED_SCHEMA.names)
    done = commit_rows(mine)
    history = schemas.versions(spark, root, specs, log=log)
    copied_under = {name: known[-1][1] for name, known in history.items()}

    free = F.col("xid") == NO_XID
    inside = dml_only(mine).filter(~free).join(done, "xid", "left")
    outside = dml_only(mine).filter(free).withColumns({"commit_lsn": F.col("lsn"), "commit_ts": F.col("source_ts")})
    names = [*FEED_SCHEMA.names, "commit_lsn", "commit_ts"]
    # One pass tags every row with its commit; each table's write then reads the tagged rows.
    tagged = inside.select(*names).unionByName(outside.select(*names)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        control, counts = together(spark, [
            partial(_control_rows, mine),
            lambda: {(r[0], r[1]): r[2] for r in tagged.groupBy("table", F.col("commit_lsn").isNotNull()).count().collect()}])
        position, changes = control
        new = schemas.advance(history, changes)
        ready = tagged.filter(F.col("commit_lsn").isNotNull())
        late = None if position is None else waiting_rows(spark, root, log, done)
        if late is not None:
            ready = ready.unionByName(late.join(done, "xid").select(*names))
        ready = ready.withColumn("source_ts", F.col("commit_ts"))

        writes, parts, kinds, details = {}, {}, {}, {}
        for name, known in history.items():
            spec = known[-1][1]
            if late is None and (name, True) not in counts:
                continue
            own = _versioned_events(ready.filter(F.col("table") == name), known, copied_under[name])
            writes[spec.events_name], parts[spec.events_name] = event_sink.prepare_events(own, spec)
            kinds[spec.events_name], details[spec.events_name] = "append", {"schema_id": len(known) - 1}
        if new:
            writes[schemas.SCHEMAS], kinds[schemas.SCHEMAS] = schemas.as_rows(spark, new), "append"
        still_open = tagged.filter(F.col("commit_lsn").isNull()).select(*FEED_SCHEMA.names)
        listed = open_xids(spark, root, log)
        if any(not ended for _, ended in counts):
            writes[OPEN_ROWS], kinds[OPEN_ROWS] = still_open.withColumn(XID_BUCKET, _bucket(F.col("xid"))), "append"
            parts[OPEN_ROWS] = [XID_BUCKET]
            added = still_open.select("xid").distinct().withColumn("at", F.lit(number).cast("bigint"))
        else:
            added = None
        if added is not None or late is not None:
            kept = None if listed is None else listed.join(done, "xid", "left_anti")
            both = [df.select("xid", "at") for df in (kept, added) if df is not None]
            xids = (both[0].unionByName(both[1]) if len(both) > 1 else both[0]).hint("rebalance")  # files by size
            writes[OPEN_XIDS], kinds[OPEN_XIDS] = xids, "list"
            details[OPEN_XIDS] = {"note": "0" if added is None and xids.isEmpty() else None}
        # An empty batch is recorded too, so that it is known when it comes again.
        number = commits.commit_tables(
            spark, root, number, writes, kind=kinds, mark=position, note=note, partition_by=parts, cluster=True,
            source=source, details=details, marks={} if writes else {"": commits.MARK}, log=log)
    finally:
        tagged.unpersist()
    if pipeline_id is not None and position is not None:
        # After the commit is durable, never before.
        saved = progress.load_progress(spark, root, pipeline_id)
        progress.save_progress(spark, root, pipeline_id, {**saved, "mode": "logical", "lsn": int(position)})
    return number


def _control_rows(feed: DataFrame) -> tuple[int | None, list]:
    """Position of the last COMMIT, and the schema changes in log order, a handful: one pass over the batch."""
    change = F.when(F.col("op") == "SCHEMA_CHANGE", F.struct("lsn", "table", "after"))
    row = feed.filter(F.col("op").isin("COMMIT", "SCHEMA_CHANGE")).agg(
        F.max(F.when(F.col("op") == "COMMIT", F.col("lsn"))), F.collect_list(change)).first()
    found = sorted(row[1], key=lambda r: r["lsn"])
    return row[0], [(r["table"], r["lsn"], SchemaChange.from_map(r["after"])) for r in found]


def _versioned_events(ready: DataFrame, known: schemas.Versions, copied_under: TableSpec) -> DataFrame:
    """Events of one table, each row read under the schema in force at its
    position and brought to the current one by field id. Snapshot rows have no
    position; they were copied under the schema known before this batch."""
    copied = (F.col("xid") == NO_XID) & (F.col("lsn") == 0)
    current = known[-1][1]
    out = conform_ids(to_events(ready.filter(copied), copied_under, lsn="commit_lsn"), copied_under, current)
    for i, (start, spec) in enumerate(known):
        rows = ready.filter(~copied)
        if i:
            rows = rows.filter(F.col("lsn") >= start)
        if i + 1 < len(known):
            rows = rows.filter(F.col("lsn") < known[i + 1][0])
        out = out.unionByName(conform_ids(to_events(rows, spec, lsn="commit_lsn"), spec, current))
    return out


def feed_row_bytes() -> Column:
    """Estimated bytes of a feed row: its images as text and its fixed columns."""
    return F.lit(60) + sum((F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) for c in ("before", "after")), F.lit(0))


def flush_bounds(batch: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> list[int]:
    """Log positions that cut a batch into flushes, each but the last the highest position of one: as many whole stretches
    of positions as stay within both limits. One row a stretch, at most ``RANGES``, reaches the driver; rows of one
    position are never parted."""
    cut = with_range(batch, batch, "lsn", "_range")
    per = cut.groupBy("_range").agg(F.count("*").alias("n"), F.sum(feed_row_bytes()).alias("b"), F.max("lsn").alias("hi")).collect()
    bounds, rows, size, last = [], 0, 0, None
    for r in sorted(per, key=lambda r: r["_range"]):
        over = max_rows is not None and rows + r["n"] > max_rows or max_bytes is not None and size + r["b"] > max_bytes
        if rows and over:
            bounds.append(last)
            rows, size = 0, 0
        rows, size, last = rows + r["n"], size + r["b"], r["hi"]
    return bounds


UPTO = "flushed up to "


def flush_batch(batch: DataFrame, batch_id: int, specs: Sequence[TableSpec], root: str, pipeline_id: str | None = None,
                stream: str = "feed", max_rows: int | None = None, max_bytes: int | None = None) -> None:
    """A micro-batch as one commit for every ``max_rows`` rows or ``max_bytes`` bytes of it, whichever is reached first.

    Each commit's log entry says up to which position it goes, so a batch that comes again goes on behind its last
    flush, wherever it would be cut now.
    """
    spark = batch.sparkSession
    log = commits.load(spark, root)
    done, edge = 0, None
    while (n := log.find(f"{stream}:{batch_id}.{done}")) is not None:
        note = next((r["note"] for r in log.rows if r[COMMIT] == n and (r["note"] or "").startswith(UPTO)), None)
        if note is None:
            return
        done, edge = done + 1, int(note.removeprefix(UPTO))
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # A row without a position belongs to the first flush.
        at = F.coalesce("lsn", F.lit(-(1 << 63)))
        rest = batch if edge is None else batch.filter(at > edge)
        for bound in flush_bounds(rest, max_rows, max_bytes):
            part = rest.filter(at <= bound)
            feed_batch(part, f"{batch_id}.{done}", specs, root, pipeline_id, stream, f"{UPTO}{bound}")
            done, rest = done + 1, batch.filter(at > bound)
        feed_batch(rest, f"{batch_id}.{done}", specs, root, pipeline_id, stream)
    finally:
        batch.unpersist()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that a checkpoint belongs to: a new checkpoint, even at an old path, is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def run_feed(stream: DataFrame, specs: Sequence[TableSpec], root: str, checkpoint: str,
             pipeline_id: str | None = None, flush_rows: int | None = None, flush_bytes: int | None = None,
             **trigger) -> StreamingQuery:
    """Start the change-feed pipeline; ``trigger`` as in ``DataStreamWriter.trigger``.

    A flush happens when any threshold is met: each trigger's interval ends one, and a batch that holds more than
    ``flush_rows`` rows or ``flush_bytes`` bytes is flushed in parts.
    """
    validate(specs)

    def each(batch: DataFrame, batch_id: int) -> None:
        name = stream_id(batch.sparkSession, checkpoint)
        if flush_rows or flush_bytes:
            flush_batch(batch, batch_id, specs, root, pipeline_id, name, flush_rows, flush_bytes)
        else:
            feed_batch(batch, batch_id, specs, root, pipeline_id, name)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# -- events -> tables --------------------------------------------------------


def materialize(spark: SparkSession, specs: Sequence[TableSpec], events_root: str, root: str,
                upto: int | None = None) -> int | None:
    """Fold all unprocessed events of all tables and commit the result once.

    What is processed is recorded in the commit that holds the result, so a
    crash at any point repeats the cycle or skips it, never half of it.
    Returns the commit, or None when there was nothing to do.
    """
    return commits.retry_commit(partial(_materialize, spark, specs, events_root, root, upto))


def _materialize(spark, specs, events_root, root, upto):
    events_log, own_log = together(spark, [partial(commits.load, spark, events_root), partial(commits.load, spark, root)])
    done = own_log.mark
    top = events_log.top if upto is None else min(events_log.top, upto)
    if top <= done:
        return None
    specs = registry.current(specs, events_log)
    history = schemas.versions(spark, events_root, specs, top, events_log)
    keyed = materializable([history[s.name][-1][1] for s in specs])
    if not keyed:
        return None
    held: list[DataFrame] = []

    def prepare(spec: TableSpec) -> tuple[dict[str, DataFrame], int]:
        fresh = event_sink.read_events(spark, events_root, spec, after=done, upto=top, log=events_log)
        if not events_log.parts(spec.events_name, done, top):
            return {}, 1
        folded = fold(fresh, spec, order=F.struct("_lsn", "_seq")).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(folded)
        ready = folded
        rows, open_ = folded.agg(F.count("*"), F.count_if(is_unresolved(spec))).first()
        if not rows:
            return {}, 1
        slots = tables.slots_for(rows)
        # Most cycles of most tables have nothing to look up; then the table is not read at all.
        if open_:
            need = unresolved(folded, spec)
            data, deletes = tables.read_keys(spark, root, spec, need.select(*spec.pk), own_log)
            ready = resolve_parts(folded, data, deletes, spec)
        return tables.delta_writes(ready, spec, folded, slots), slots

    try:
        writes, parts, kinds, details = {}, {}, {}, {}
        for spec, (own, slots) in zip(keyed, together(spark, [partial(prepare, s) for s in keyed])):
            writes |= own
            parts |= tables.partition_map(spec, slots)
            kinds |= tables.delta_kinds(spec)
            details |= {t: {"slots": slots, "schema_id": len(history[spec.name]) - 1} for t in own}
        return commits.commit_tables(
            spark, root, own_log.top + 1, writes, kind=kinds, mark=top, partition_by=parts, cluster=True, details=details,
            marks={} if writes else {"": commits.MARK}, log=own_log)
    finally:
        for df in held:
            df.unpersist()


def run_materializer(spark: SparkSession, specs: Sequence[TableSpec], events_root: str, root: str,
                     checkpoint: str, **trigger) -> StreamingQuery:
    """Materialize whenever the events log grew, on its own interval."""
    if not commits.files.names(spark, commits.log_path(events_root)):
        commits.ensure_log(spark, events_root)
    grown = spark.readStream.schema(commits.LOG_SCHEMA).parquet(commits.log_path(events_root))
    return (
        grown.writeStream.foreachBatch(lambda b, i: materialize(spark, specs, events_root, root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# -- poll -> tables ----------------------------------------------------------


def poll_cycle(spark: SparkSession, sources: Mapping[str, DataFrame], specs: Sequence[TableSpec],
               root: str, pipeline_id: str = "poll", lag: str | None = None,
               tie_break: Mapping[str, Sequence[str]] | None = None) -> int | None:
    """One poll of every table: new rows, latest per key, upsert, then the watermark.

    The watermark moves only in the progress row saved after the commit, so a
    failed cycle reads the same rows again.
    """
    validate(specs, "query")
    return commits.retry_commit(partial(_poll_cycle, spark, sources, specs, root, pipeline_id, lag, tie_break))


def _poll_cycle(spark, sources, specs, root, pipeline_id, lag, tie_break):
    saved = progress.load_progress(spark, root, pipeline_id)
    marks = dict(saved["watermarks"])
    log = commits.load(spark, root)
    writes, parts, kinds, details, held = {}, {}, {}, {}, []
    try:
        for spec in specs:
            last = marks.get(spec.name)
            fresh = poll(sources[spec.name].select(*spec.columns), spec.watermark, last, lag)
            order = [spec.watermark, *(tie_break or {}).get(spec.name, ())]
            newest = latest_per_key(fresh, spec.pk, order)
            if last is not None and lag is not None:
                # What the lag reads again is mostly there already; only rows that differ are written. The table is
                # cut to the polled keys, data and deletes, before they meet.
                newest = newest.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(newest)
                keys, on = newest.select(*spec.pk).alias("b"), keys_match(spec.pk, spec.nullable_keys)
                data, deletes = (df.alias("f").join(keys, on, "left_semi")
                                 for df in tables.read_keys(spark, root, spec, newest, log))
                stored = scan(data, deletes, spec.pk, nullable=spec.nullable_keys).select(*spec.columns)
                newest = newest.alias("f").join(stored.alias("b"), keys_match(spec.columns, spec.columns), "left_anti")
            rows = as_folded(newest, spec).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(rows)
            top, count = rows.agg(mark_of(rows, spec.watermark), F.count("*")).first()
            if top is None:
                continue
            kind = spec.schema[spec.watermark].dataType
            if last is None or spark.range(1).select(F.lit(top).cast(kind) > F.lit(last).cast(kind)).first()[0]:
                marks[spec.name] = top
            slots = tables.slots_for(count)
            own = tables.delta_writes(rows, spec, slots=slots)
            writes |= own
            parts |= tables.partition_map(spec, slots)
            kinds |= tables.delta_kinds(spec)
            details |= {t: {"slots": slots} for t in own}
        if not writes:
            return None
        commit = commits.commit_tables(spark, root, log.top + 1, writes, kind=kinds, partition_by=parts, cluster=True,
                                       details=details, log=log)
        progress.save_progress(spark, root, pipeline_id, {**saved, "mode": "query", "watermarks": marks})
    finally:
        for df in held:
            df.unpersist()
    return commit


# -- snapshot ----------------------------------------------------------------


def snapshot_batch(feed: DataFrame, specs: Sequence[TableSpec], root: str, name: str = "initial") -> None:
    """Write a snapshot feed (text images of all tables) as one events commit; the stream
    continues after it. A snapshot of the same ``name`` is written once."""
    feed_batch(feed.select(*[
        F.col(c) if c in feed.columns else F.lit(None).cast(FEED_SCHEMA[c].dataType).alias(c)
        for c in FEED_SCHEMA.names
    ]), 0, specs, root, stream=f"snapshot {name}")


def run_snapshot(spark: SparkSession, sources: Mapping[str, DataFrame] | Pinned, specs: Sequence[TableSpec], root: str,
                 as_of: Column, pipeline_id: str, skip: Sequence[str] = ()) -> list[str]:
    """Copy tables as typed rows, one commit a table, and record each as done.

    Of a :class:`Pinned` source all tables are read at one version, the one that was current when the snapshot began; it
    is recorded before anything is copied, and a run that goes on reads it too. A run that was interrupted goes on with
    the tables that are not recorded; a table whose commit was published before its record was saved is only recorded.
    Rows are read under the table's current schema version. Returns the tables copied.
    """
    validate(specs)
    saved = progress.load_progress(spark, root, pipeline_id)
    done, copied = list(saved["snapshotted_tables"]), []
    if isinstance(sources, Pinned):
        if saved["snapshot_version"] is None:
            saved["snapshot_version"] = sources.current()
            progress.save_progress(spark, root, pipeline_id, {**saved, "mode": "logical"})
        read, names = partial(sources.read, version=saved["snapshot_version"]), list(sources.tables)
    else:
        read, names = sources.__getitem__, list(sources)
    log = commits.load(spark, root)
    versions = schemas.versions(spark, root, specs, log=log)
    for name in pending_tables(names, done, skip):
        known = versions[qualified(name)]
        spec, source = known[-1][1], f"snapshot {pipeline_id}:{qualified(name)}"
        if commits.load(spark, root).find(source) is None:
            rows, parts = event_sink.prepare_events(snapshot_scan(read(name), spec, as_of), spec)
            commits.commit_tables(spark, root, None, {spec.events_name: rows}, partition_by={spec.events_name: parts},
                                  cluster=True, source=source, details={spec.events_name: {"schema_id": len(known) - 1}})
            copied.append(spec.name)
        done.append(spec.name)
        progress.save_progress(spark, root, pipeline_id, {**saved, "mode": "logical", "snapshotted_tables": done})
    progress.save_progress(spark, root, pipeline_id,
                           {**saved, "mode": "logical", "snapshotted_tables": done, "snapshot_complete": True})
    return copied


def pinned_lake(spark: SparkSession, root: str, specs: Sequence[TableSpec]) -> Pinned:
    """Materialized tables as a snapshot's source: a version is a commit."""
    by_name = {s.name: s for s in specs}
    return Pinned(list(by_name), partial(commits.last_commit, spark, root),
                  lambda name, version: tables.read_state(spark, root, by_name[qualified(name)], as_of=version))
