"""Snapshots, polls, readers (S rows)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators.envelope import key_scan, parse_events, to_events
from millrace.operators.mor import between, live_data
from millrace.plans.fixtures import COMMITS, LOG, LOG_SPEC, change_log, commit_log, table
from millrace.plans.registry import register
from millrace.sources.poll import chunks, poll, with_chunk
from millrace.sources.relational import profile
from millrace.sources.snapshot import select_tables, snapshot_all, snapshot_scan
from millrace.session import work_dir
from millrace.sinks import events as event_sink, progress
from millrace.spec import TableSpec
from millrace.streaming.pipeline import run_snapshot

AS_OF = "2024-06-01 00:00:00"


def _as_of(kind: str = "timestamp_ntz"):
    return F.lit(AS_OF).cast(kind)


@register("s1_snapshot_scan", f"""select 'I' as _op, 0::bigint as _lsn, timestamp '{AS_OF}' as _ts, 0::bigint as _seq,
  cast(null as varchar) as _unchanged_cols, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority from orders""")
def s1(spark, d):
    o = table(spark, d, "orders")
    return snapshot_scan(o, TableSpec.from_df(o, "orders", ["o_orderkey"]), _as_of())


SNAP = ["customer", "orders", "part", "supplier"]


@register("s2_snapshot_all_tables", """select 'public.customer' as "table", 'INSERT' as op, count(*) as n from customer
union all select 'public.orders', 'INSERT', count(*) from orders
union all select 'public.part', 'INSERT', count(*) from part
union all select unnest(['public.customer', 'public.orders', 'public.part']), 'SNAPSHOT_TABLE_COMPLETE', 1
union all select null, 'SNAPSHOT_COMPLETE', 1""")
def s2(spark, d):
    """Four tables, one of them finished before an interruption."""
    feed = snapshot_all({t: table(spark, d, t) for t in SNAP}, _as_of("timestamp"), done=["supplier"])
    return feed.groupBy("table", "op").agg(F.count("*").alias("n"))


@register("s2_resume_after_crash", """select 'public.orders' as "table", count(*) as n, 1::bigint as commits from orders
union all select 'public.part', count(*), 1 from part""")
def s2_resume(spark, d):
    """The copy dies after the first table's commit, before anything of the second; the next run copies only that."""
    root = work_dir(spark, "s2r")
    sources = {t: table(spark, d, t) for t in ("orders", "part")}
    specs = [TableSpec.from_df(sources["orders"], "orders", ["o_orderkey"]), TableSpec.from_df(sources["part"], "part", ["p_partkey"])]
    at = _as_of("timestamp")
    broken = {"orders": sources["orders"], "part": sources["part"].select("p_partkey")}  # the copy fails here
    try:
        run_snapshot(spark, broken, specs, root, at, "p")
    except AnalysisException:
        pass
    if progress.load_progress(spark, root, "p")["snapshotted_tables"] != ["public.orders"]:
        raise AssertionError("the first table must be recorded")
    if run_snapshot(spark, sources, specs, root, at, "p") != ["public.part"]:
        raise AssertionError("only the second table must be copied")
    if not progress.load_progress(spark, root, "p")["snapshot_complete"]:
        raise AssertionError("the snapshot must be recorded as complete")
    out = None
    for s in specs:
        one = event_sink.read_events(spark, root, s).agg(F.count("*").alias("n"), F.countDistinct("_commit").alias("commits")).select(
            F.lit(s.name).alias("table"), "n", "commits")
        out = one if out is None else out.unionByName(one)
    return out


@register("s2_snapshot_rows", "select * from orders")
def s2_rows(spark, d):
    """Rows sent as text and read back with the table's types."""
    o = table(spark, d, "orders")
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"])
    feed = snapshot_all({"orders": o}, _as_of("timestamp"))
    rows = feed.filter(F.col("table") == spec.name).withColumn("unchanged_cols", F.lit(None).cast("array<string>"))
    return to_events(rows, spec).select(*spec.columns)


@register("s3_snapshot_selection", """select 'public.u' || user_id as "table", user_id % 10 = 0 as skip_snapshot
from events group by user_id having user_id % 10 <> 0 and count(*) filter (where event_type = 'error' and event_id % 4 = 0) < 5""")
def s3(spark, d):
    """One table per user; skipped by flag, or done when its log says so."""
    name = F.concat(F.lit("public.u"), F.col("user_id"))
    e = table(spark, d, "events")
    catalog = e.groupBy("user_id").agg(F.count("*")).select(name.alias("table"), (F.col("user_id") % 10 == 0).alias("skip_snapshot"))
    mark = (F.col("event_type") == "error") & (F.col("event_id") % 4 == 0)
    progress = e.groupBy("user_id").agg((F.count_if(mark) >= 5).alias("done")).select(name.alias("table"), "done")
    return select_tables(catalog, progress)


@register("s4_change_feed_stream", "select count(*) as n, count(distinct event_id) as ids, max(event_id) as last from events")
def s4(spark, d):
    """The events file read as a stream into a table, then counted."""
    from millrace.session import work_dir

    schema = table(spark, d, "events").schema
    out = work_dir(spark, "s4")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    (stream.writeStream.format("parquet").option("checkpointLocation", out + "/ck").option("path", out + "/rows")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out + "/rows").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"), F.max("event_id").alias("last"))


MID = "2024-01-16 12:00:00"


@register("s5_watermark_poll", f"select * from events where ts > timestamp '{MID}'")
def s5(spark, d):
    return poll(table(spark, d, "events"), "ts", F.lit(MID).cast("timestamp_ntz"))


@register("s5_first_poll", "select event_id, ts from (select event_id, case when event_id % 9 <> 0 then ts end as ts from events) where ts is not null")
def s5_first(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 9 != 0, F.col("ts")).alias("ts"))
    return poll(e, "ts")


@register("s6_events_since_commit", f"with {COMMITS}\nselect * from clog where _commit > 9 and _commit <= 34")
def s6(spark, d):
    return between(commit_log(spark, d), 9, 34)


@register("s7_parse_events", f"""with {LOG}
select _op, _lsn, _seq, cast(coalesce(len(string_split(_unchanged_cols, ',')), 0) as integer) as n_unchanged,
       string_split(_unchanged_cols, ',')[1] as first_unchanged, user_id, slot, value, props from log""")
def s7(spark, d):
    return parse_events(change_log(spark, d), LOG_SPEC).select(
        "_op", "_lsn", "_seq", F.size("_unchanged").alias("n_unchanged"),
        F.get("_unchanged", F.lit(0)).alias("first_unchanged"), *LOG_SPEC.columns)


@register("s8_key_scan", "select o_orderkey, o_custkey from orders")
def s8(spark, d):
    return key_scan(table(spark, d, "orders"), ["o_orderkey", "o_custkey"])


@register("s9_live_data", f"with {COMMITS}\nselect _commit, user_id, slot, value, props from clog where _op <> 'D' and _commit <= 30")
def s9(spark, d):
    data = commit_log(spark, d).filter(F.col("_op") != "D").select("_commit", *LOG_SPEC.columns)
    return live_data(data, 30)


@register("s10_chunked_scan", """select l_orderkey // 100 * 100 as lo, l_orderkey // 100 * 100 + 100 as hi, count(*) as n,
  min(l_orderkey) as first, max(l_orderkey) as last from lineitem group by all""")
def s10(spark, d):
    """Chunk bounds from the key range, rows of each chunk."""
    li = table(spark, d, "lineitem").select("l_orderkey")
    lo, hi = li.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    per = with_chunk(li, "l_orderkey", 100).groupBy("chunk").agg(
        F.count("*").alias("n"), F.min("l_orderkey").alias("first"), F.max("l_orderkey").alias("last"))
    bounds = chunks(spark, lo, hi, 100)
    return bounds.join(per, bounds["lo"] == per["chunk"]).select("lo", "hi", "n", "first", "last")


@register("s11_table_columns", f"""with {LOG}
select 1 as ordinal, 'user_id' as "column", 'bigint' as type, 1 as key_position, count(*) - count(user_id) as nulls from log
union all select 2, 'slot', 'integer', 2, count(*) - count(slot) from log
union all select 3, 'value', 'double precision', 0, count(*) - count(value) from log
union all select 4, 'props', 'text', 0, count(*) - count(props) from log""")
def s11(spark, d):
    rows = change_log(spark, d).select(*LOG_SPEC.columns)
    return profile(rows, TableSpec.from_df(rows, "activity", ["user_id", "slot"]))
