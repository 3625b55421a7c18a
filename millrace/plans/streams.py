"""Streaming pipelines run to completion on file drops (W rows, T8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.metrics import materialization_lag
from millrace.plans.fixtures import (
    COMMITTED, FEED, HALF, LOG, LOG_SPEC, STATE, base_and_batch, change_log, drops, half,
    table, text_feed,
)
from millrace.plans.registry import register
from millrace.plans.transactions import REPLAY
from millrace.session import work_dir
from millrace.sinks import commits, events as event_sink, tables as table_sink
from millrace.sources.feed import FEED_SCHEMA, read_feed
from millrace.sources.snapshot import snapshot_all
from millrace.spec import TableSpec
from millrace.streaming.gate import read_gated, run_gate
from millrace.streaming.pipeline import (
    OPEN_ROWS, feed_batch, open_rows, materialize, poll_cycle, run_feed, run_materializer, snapshot_batch,
)

FINAL = f"with {REPLAY}\nselect user_id, slot, value, props from f where op <> 'D'"


def _drop(df, folder):
    df.write.mode("append").parquet(folder)


def _feed_through(spark, d, root, n=3, after_each=None):
    """Drop the feed in ``n`` parts, running the feed pipeline after each."""
    for i, part in enumerate(drops(text_feed(spark, d), n)):
        _drop(part, f"{root}/in")
        run_feed(read_feed(spark, f"{root}/in"), [LOG_SPEC], f"{root}/events", f"{root}/ck").awaitTermination()
        if after_each:
            after_each(i)


@register("w1_feed_to_events", f"""with {COMMITTED}
select _op, commit_lsn as _lsn, pos as _seq, commit_ts as _ts, _unchanged_cols, user_id, slot, value, props from committed""")
def w1(spark, d):
    root = work_dir(spark, "w1")
    _feed_through(spark, d, root)
    rows = event_sink.read_events(spark, f"{root}/events", LOG_SPEC)
    return rows.select("_op", "_lsn", "_seq", F.col("_ts").cast("timestamp_ntz").alias("_ts"), "_unchanged_cols",
                       *LOG_SPEC.columns)


@register("w2_continuous_materialization", FINAL)
def w2(spark, d):
    root = work_dir(spark, "w2")

    def catch_up(_):
        run_materializer(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables", f"{root}/mck").awaitTermination()

    _feed_through(spark, d, root, after_each=catch_up)
    return table_sink.read_state(spark, f"{root}/tables", LOG_SPEC)


USERS = TableSpec.of("public.users", [
    ("user_id", "bigint", False), ("event_id", "bigint"), ("ts", "timestamp"), ("event_type", "text")],
    pk=["user_id"], watermark="ts")


@register("w3_poll_loop", """select user_id, event_id, ts, event_type from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def w3(spark, d):
    """Three polls of a growing table, the last one finding nothing."""
    root = work_dir(spark, "w3")
    e = table(spark, d, "events").select(*USERS.columns)
    seen = e.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    done = [poll_cycle(spark, {USERS.name: s}, [USERS], root, tie_break={USERS.name: ["event_id"]})
            for s in (seen, e, e)]
    if done != [0, 1, None]:
        raise AssertionError(f"unexpected commits {done}")
    return table_sink.read_state(spark, root, USERS)


@register("w4_snapshot_then_stream", f"with {STATE}\nselect * from state")
def w4(spark, d):
    """A snapshot at half of the log, then a stream that starts well before it: overlap is harmless."""
    root = work_dir(spark, "w4")
    base, _ = base_and_batch(spark, d)
    at = F.lit("2024-01-15").cast("timestamp")
    snapshot_batch(snapshot_all({LOG_SPEC.name: base}, at), [LOG_SPEC], f"{root}/events")
    overlap = (F.col("pos") * 3 >= half(spark, d) * 2) & F.col("op").isin("INSERT", "UPDATE", "DELETE")
    _drop(text_feed(spark, d).filter(overlap).withColumn("xid", F.lit(0).cast("bigint")), f"{root}/in")
    run_feed(read_feed(spark, f"{root}/in"), [LOG_SPEC], f"{root}/events", f"{root}/ck").awaitTermination()
    materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables", upto=0)
    materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables")
    return table_sink.read_state(spark, f"{root}/tables", LOG_SPEC)


@register("w5_restart_and_resume", FINAL)
def w5(spark, d):
    """The second drop's batch dies after its files are written, before they are published."""
    root = work_dir(spark, "w5")
    parts = drops(text_feed(spark, d), 3)

    def run(fn):
        q = (read_feed(spark, f"{root}/in").writeStream.foreachBatch(fn)
             .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    def good(b, i):
        feed_batch(b, i, [LOG_SPEC], f"{root}/events")

    def dies(b, i):
        rows = b.filter("table is not null").select(*FEED_SCHEMA.names)
        commits.write_part(rows, f"{root}/events", OPEN_ROWS, i)
        raise RuntimeError("lost")

    _drop(parts[0], f"{root}/in")
    run(good)
    _drop(parts[1], f"{root}/in")
    try:
        run(dies)
    except Exception as e:
        if "lost" not in str(e):
            raise
    else:
        raise AssertionError("the batch must fail")
    _drop(parts[2], f"{root}/in")
    run(good)
    materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables")
    return table_sink.read_state(spark, f"{root}/tables", LOG_SPEC)


@register("w5_new_checkpoint", FINAL)
def w5_new_checkpoint(spark, d):
    """The checkpoint is lost between two drops: the new stream numbers its batches from 0 again, on the old root."""
    root = work_dir(spark, "w5n")
    for i, part in enumerate(drops(text_feed(spark, d), 2)):
        _drop(part, f"{root}/in{i}")
        run_feed(read_feed(spark, f"{root}/in{i}"), [LOG_SPEC], f"{root}/events", f"{root}/ck{i}").awaitTermination()
        materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables")
    return table_sink.read_state(spark, f"{root}/tables", LOG_SPEC)


@register("w1_duplicate_commit", f"""with {COMMITTED}
select _op, pos as _seq, user_id, slot, value, props from committed""")
def w1_duplicate_commit(spark, d):
    """Every COMMIT is sent twice, in the batch of its rows and in one that starts again elsewhere."""
    root = work_dir(spark, "w1d")
    feed = text_feed(spark, d)
    again = feed.filter(F.col("op") == "COMMIT")
    for i, part in enumerate((feed.unionByName(again), again)):
        _drop(part, f"{root}/in")
        run_feed(read_feed(spark, f"{root}/in"), [LOG_SPEC], f"{root}/events", f"{root}/ck").awaitTermination()
    return event_sink.read_events(spark, f"{root}/events", LOG_SPEC).select("_op", "_seq", *LOG_SPEC.columns)


GATED = f"""with {FEED}
select dml.xid, pos, op, done.commit_lsn from dml join done using (xid) where dml.xid <> 0"""


@register("w6_stateful_gate", GATED)
def w6(spark, d):
    """Rows wait for their commit over the batches of a stream."""
    root = work_dir(spark, "w6")
    for part in drops(text_feed(spark, d).filter(F.coalesce("xid", F.lit(0)) != 0), 2):
        _drop(part, f"{root}/in")
        run_gate(read_feed(spark, f"{root}/in"), f"{root}/out", f"{root}/ck", "10 days").awaitTermination()
    return read_gated(spark, f"{root}/out").select("xid", "pos", "op", "commit_lsn").filter(F.col("commit_lsn").isNotNull())


@register("w6_late_rows", GATED)
def w6_late_rows(spark, d):
    """The feed arrives newest half first, so that the other half's rows and commits are far behind the bound: a row
    that meets its commit in one batch is committed, not expired, and none is dropped."""
    root = work_dir(spark, "w6l")
    feed = text_feed(spark, d).filter(F.coalesce("xid", F.lit(0)) != 0)
    edge = feed.agg((F.max("xid") / 2)).scalar()
    for late in (False, True):
        part = feed.filter(F.col("xid") < edge) if late else feed.filter(F.col("xid") >= edge)
        _drop(part, f"{root}/in")
        run_gate(read_feed(spark, f"{root}/in"), f"{root}/out", f"{root}/ck", "1 second").awaitTermination()
    rows = read_gated(spark, f"{root}/out").select("xid", "pos", "op", "commit_lsn")
    return rows.filter(F.col("commit_lsn").isNotNull())


@register("w7_late_rows_with_lag", """with early as (select * from events where event_id % 10 <> 3 and ts < timestamp '2024-01-16'),
seen as (select * from early union all select * from events where ts > (select max(ts) from early) - interval 5 day)
select distinct user_id, event_id, ts, event_type from seen
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def w7(spark, d):
    """Every tenth row shows up late; the second poll reads five days again."""
    root = work_dir(spark, "w7")
    e = table(spark, d, "events").select(*USERS.columns)
    early = e.filter((F.col("event_id") % 10 != 3) & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
    for source, lag in ((early, None), (e, "5 days")):
        poll_cycle(spark, {USERS.name: source}, [USERS], root, lag=lag, tie_break={USERS.name: ["event_id"]})
    return table_sink.read_state(spark, root, USERS)


@register("w8_fold_across_batches", f"with {STATE}\nselect * from state")
def w8(spark, d):
    """Three event batches folded one after the other onto the stored table, then a compaction."""
    root = work_dir(spark, "w8")
    log = change_log(spark, d)
    third = table(spark, d, "events").agg(F.max("event_id") + 1).scalar()
    for i in range(3):
        part = log.filter(F.floor(F.col("_seq") * 3 / third) == i)
        event_sink.append_events(part, LOG_SPEC, f"{root}/events", i)
        materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables")
    table_sink.compact(spark, f"{root}/tables", LOG_SPEC)
    return table_sink.read_state(spark, f"{root}/tables", LOG_SPEC)


@register("w9_two_tier_lag", f"""with {LOG}
select 'public.activity' as "table", max(_lsn) as events_lsn, max(_lsn) filter (where _seq < {HALF}) as materialized_lsn,
  max(_lsn) - max(_lsn) filter (where _seq < {HALF}) as lag from log""")
def w9(spark, d):
    """The change log is current while the table has taken in its first commit only."""
    root = work_dir(spark, "w9")
    log, edge = change_log(spark, d), half(spark, d)
    for i, part in enumerate((log.filter(F.col("_seq") < edge), log.filter(F.col("_seq") >= edge))):
        event_sink.append_events(part, LOG_SPEC, f"{root}/events", i)
        if i == 0:
            materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables")
    name = F.lit(LOG_SPEC.name).alias("table")
    written = event_sink.read_events(spark, f"{root}/events", LOG_SPEC)
    done = written.filter(F.col("_commit") <= commits.last_mark(spark, f"{root}/tables"))
    return materialization_lag(written.select(name, "_lsn"), done.select(name, "_lsn"))


@register("t8_drain", f"""with {COMMITTED}
select 'flushed' as what, count(*) as n from committed
union all select 'open', (select count(*) from dml) - count(*) from committed""")
def t8(spark, d):
    """Everything available is taken in; committed rows are flushed, open ones are left waiting."""
    root = work_dir(spark, "t8")
    _feed_through(spark, d, root, n=1)
    at = f"{root}/events"
    flushed = event_sink.read_events(spark, at, LOG_SPEC).select(F.lit("flushed").alias("what"))
    waiting = open_rows(spark, at).select(F.lit("open").alias("what"))
    return flushed.unionByName(waiting).groupBy("what").agg(F.count("*").alias("n"))
