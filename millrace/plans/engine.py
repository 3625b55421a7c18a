"""Queries that go through the engine's own log, progress and files from end to end."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import mor
from millrace.operators.fold import as_folded
from millrace.operators.metrics import snapshot_progress
from millrace.plans.fixtures import table
from millrace.plans.registry import register
from millrace.session import work_dir
from millrace.sinks import commits, events as event_sink, files, progress, registry, schemas, tables as table_sink
from millrace.sources.feed import FEED_SCHEMA
from millrace.sources.snapshot import snapshot_all
from millrace.spec import SchemaChange, TableSpec
from millrace.streaming.pipeline import feed_batch, flush_batch, materialize, pinned_lake, run_snapshot

AT = "2024-06-01 00:00:00"


def _at():
    return F.lit(AT).cast("timestamp")


def _as_feed(rows, lsn=None):
    """Rows of :func:`snapshot_all` as feed rows, at a position of their own."""
    have = {c: F.col(c) if c in rows.columns else F.lit(None) for c in FEED_SCHEMA.names}
    if lsn is not None:
        have |= {"lsn": lsn, "pos": lsn}
    return rows.filter(F.col("table").isNotNull()).select(*[have[c].cast(FEED_SCHEMA[c].dataType).alias(c) for c in FEED_SCHEMA.names])


@register("f1_tables_at_run_time", """select 'public.customer' as "table", count(*) as n from customer
union all select 'public.supplier', count(*) + count(*) filter (where s_suppkey % 2 = 0) from supplier""")
def f1_run_time(spark, d):
    """A feed of two tables tracks one; the other is added with its rows, the first one is removed later on."""
    root = work_dir(spark, "f1r")
    c, s = (table(spark, d, t) for t in ("customer", "supplier"))
    customer, supplier = (TableSpec.from_df(df, n, [k]) for df, n, k in ((c, "customer", "c_custkey"), (s, "supplier", "s_suppkey")))

    def both(odd):
        return _as_feed(snapshot_all({"customer": c.filter(F.col("c_custkey") % 2 == odd), "supplier": s.filter(F.col("s_suppkey") % 2 == odd)}, _at()))

    feed_batch(both(0), 0, [customer], root)
    registry.add_table(spark, root, [customer], supplier, s.filter(F.col("s_suppkey") % 2 == 0), _at())
    feed_batch(both(1), 1, [customer], root)
    registry.remove_table(spark, root, [customer], "customer")
    feed_batch(both(0), 2, [customer], root)
    out = [event_sink.read_events(spark, root, x).select(F.lit(x.name).alias("table")) for x in (customer, supplier)]
    return out[0].unionByName(out[1]).groupBy("table").agg(F.count("*").alias("n"))


@register("k8_flush_limits", """select limits, (select count(*) from orders) as "rows", 0::bigint as over
from (values ('rows'), ('bytes'), ('interval')) t(limits)""")
def k8_limits(spark, d):
    """The same batch flushed by a row limit, by a byte limit, and as its interval brings it: rows taken in, and
    flushes over the limit."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"])
    key = F.element_at("after", "o_orderkey").cast("bigint")
    batch = _as_feed(snapshot_all({"orders": o}, _at()).filter(F.col("op") == "INSERT"), key)
    most = max(2, o.count() // 4)
    out = None
    for name, limits, bound in (("rows", {"max_rows": most}, most), ("bytes", {"max_bytes": most * 150}, most * 2), ("interval", {}, None)):
        root = work_dir(spark, f"k8{name}")
        if limits:
            flush_batch(batch, 0, [spec], root, **limits)
        else:
            feed_batch(batch, 0, [spec], root)
        per = event_sink.read_events(spark, root, spec).groupBy("_commit").agg(F.count("*").alias("n"))
        over = F.count_if(F.col("n") > bound) if bound else F.count_if(F.lit(False))
        one = per.agg(F.sum("n").alias("rows"), over.alias("over")).select(F.lit(name).alias("limits"), "rows", "over")
        out = one if out is None else out.unionByName(one)
    return out


PRICED = "select o_orderkey, case when o_orderstatus = 'F' then 'Z' else o_orderstatus end as o_orderstatus, o_totalprice from orders"


@register("s11_complete_before_images", PRICED)
def s11_before(spark, d):
    """Updates that leave the price out, from a source whose before-images are complete: nothing is looked up."""
    ev, root = work_dir(spark, "s11e"), work_dir(spark, "s11t")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"], full_before_images=True)
    rows = _as_feed(snapshot_all({"orders": o}, _at()).filter(F.col("op") == "INSERT"))
    changed = rows.filter(F.element_at("after", "o_orderstatus") == "F").withColumns({
        "op": F.lit("UPDATE"), "before": F.col("after"), "lsn": F.lit(9).cast("bigint"), "pos": F.lit(9).cast("bigint"),
        "after": F.map_concat(F.map_filter("after", lambda k, _: k == "o_orderkey"), F.create_map(F.lit("o_orderstatus"), F.lit("Z"))),
        "unchanged_cols": F.array(F.lit("o_totalprice"))}).select(*FEED_SCHEMA.names)
    for n, batch in enumerate((rows, changed)):
        feed_batch(batch, n, [spec], ev)
        materialize(spark, [spec], ev, root)
    return table_sink.read_state(spark, root, spec)


@register("a10_history_with_schemas", """select o_orderkey % 3 as _commit, 'append' as kind, least(o_orderkey % 3, 1)::integer as schema_id,
  nullif(o_orderkey % 3 - 1, -1) as previous, count(*) as n, case when o_orderkey % 3 = 0 then 3 else 4 end::integer as "columns" from orders group by 1""")
def a10_schemas(spark, d):
    """Three commits, a column added before the second one: each names the schema it was written under."""
    root = work_dir(spark, "a10")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"])
    for n in range(3):
        batch = _as_feed(snapshot_all({"orders": o.filter(F.col("o_orderkey") % 3 == n)}, _at()), F.lit(100 * n + 1))
        if n == 1:
            change = SchemaChange(added=(("note", "text"),)).to_map()
            row = spark.range(1).select(F.lit(spec.name).alias("table"), F.lit("SCHEMA_CHANGE").alias("op"), F.lit(0).alias("xid"),
                                        F.create_map(*[F.lit(x) for kv in change.items() for x in kv]).alias("after"))
            batch = batch.unionByName(_as_feed(row, F.lit(50)))
        feed_batch(batch, n, [spec], root)
    listed = commits.history(spark, root).filter(F.col("table") == spec.events_name).select("_commit", "kind", "schema_id", "previous")
    wide = spark.createDataFrame([(n, len(schemas.at_commit(spark, root, spec, spec.events_name, n).columns)) for n in range(3)], "_commit long, columns int")
    now = schemas.latest(spark, root, [spec])[0]
    counts = event_sink.read_events(spark, root, now).groupBy("_commit").agg(F.count("*").alias("n"))
    return listed.join(counts, "_commit").join(wide, "_commit")


@register("s2_one_version_of_all_tables", """select 'public.orders' as "table", count(*) as n, max(o_orderkey) as top from orders
union all select 'public.part', count(*), max(p_partkey) from part""")
def s2_pinned(spark, d):
    """Two lake tables lose their rows while the snapshot runs: both come out as of the version it began with."""
    lake, root = work_dir(spark, "s2l"), work_dir(spark, "s2e")
    rows = {"public.orders": table(spark, d, "orders").select("o_orderkey"), "public.part": table(spark, d, "part").select("p_partkey")}
    specs = [TableSpec.from_df(df, n, df.columns) for n, df in rows.items()]

    def commit(op):
        made = {}
        for s in specs:
            made |= table_sink.delta_writes(as_folded(rows[s.name], s).withColumn("op", F.lit(op)), s)
        commits.commit_tables(spark, lake, None, made, kind="delta")

    commit("I")
    source = pinned_lake(spark, lake, specs)
    first = []

    def busy(name, version):
        if not first:
            commit("D")
        first.append(name)
        return source.read(name, version)

    run_snapshot(spark, type(source)(source.tables, source.current, busy), specs, root, _at(), "p")
    if table_sink.read_state(spark, lake, specs[0]).count():
        raise AssertionError("the tables must be empty by now")
    out = None
    for s in specs:
        one = event_sink.read_events(spark, root, s).agg(F.count("*").alias("n"), F.max(s.pk[0]).alias("top")).select(F.lit(s.name).alias("table"), "n", "top")
        out = one if out is None else out.unionByName(one)
    return out


K7_FILE = 32 << 20


@register("k7_measured_sizes", "select n as _commit, (select count(*) from lineitem) as \"rows\", 0::bigint as files_off from (values (0::bigint), (1)) t(n)")
def k7_measured(spark, d):
    """Two commits in files of a sixth of the table's size each, ``K7_FILE`` at most as a file is one task's, measured
    from a sample and then from the first commit: files whose bytes are more than a quarter off, the smallest one aside."""
    root = work_dir(spark, "k7m")
    li = table(spark, d, "lineitem").hint("rebalance").persist()
    commits.commit_tables(spark, root, None, {"probe": li})
    target = min(K7_FILE, commits.load(spark, root).entries("probe")[0]["bytes"] // 6)
    for _ in range(2):
        commits.commit_tables(spark, root, None, {"lineitem": li}, target_bytes={"lineitem": target})
    li.unpersist()
    rows = commits.read_table(spark, root, "lineitem", li.schema)
    per = rows.groupBy("_commit", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).agg(F.count("*").alias("n"))
    off = (F.col("b") > 1.25 * target) | (F.col("b") < 0.75 * target)
    smallest = F.min(F.struct("b", "f"))["f"]
    ends = per.groupBy("_commit").agg(smallest.alias("f")).withColumn("last", F.lit(True))
    return per.join(ends, ["_commit", "f"], "left").groupBy((F.col("_commit") - 1).alias("_commit")).agg(
        F.sum("n").alias("rows"), F.count_if(off & F.col("last").isNull()).alias("files_off"))


@register("k10_saved_progress", "select event_type as pipeline_id, max(event_id) as lsn from events group by 1")
def k10_saved(spark, d):
    """Every pipeline (one an event type) saves its first and then its last position; the later one counts."""
    root = work_dir(spark, "k10s")
    ends = table(spark, d, "events").groupBy("event_type").agg(F.min("event_id").alias("a"), F.max("event_id").alias("b")).collect()
    for r in ends:
        for lsn in (r["a"], r["b"]):
            progress.save_progress(spark, root, r["event_type"], {"lsn": lsn})
    return progress.progress_table(spark, root).select("pipeline_id", F.get_json_object("progress", "$.lsn").cast("bigint").alias("lsn"))


@register("m6_lookup_by_key_hash", """select o_orderkey, o_orderstatus from orders
where o_orderkey in (select l_orderkey from lineitem group by 1 having sum(l_quantity) > (select 0.97 * max(q) from (select sum(l_quantity) as q from lineitem group by l_orderkey)))""")
def m6_lookup(spark, d):
    """The orders with the largest quantities, found in a table of sixteen hash slots and a later delta: only the slots
    and deltas that hold one of the keys are opened."""
    root = work_dir(spark, "m6")
    o = table(spark, d, "orders").select("o_orderkey", F.lit("?").alias("o_orderstatus"))
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"])
    commits.commit_tables(spark, root, None, table_sink.delta_writes(as_folded(o, spec), spec), kind="delta")
    table_sink.compact(spark, root, spec, slots=16)
    real = as_folded(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), spec)
    writes = table_sink.delta_writes(real, spec, slots=2)
    commits.commit_tables(spark, root, None, writes, kind=table_sink.delta_kinds(spec), partition_by=table_sink.partition_map(spec, 2),
                          details={t: {"slots": 2} for t in writes})
    sums = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    top = sums.agg(F.max("q") * 0.97).scalar()
    keys = sums.filter(F.col("q") > top).select("o_orderkey")
    log = commits.load(spark, root)
    data, deletes = table_sink.read_keys(spark, root, spec, keys, log)
    few = len(table_sink.lookup_parts(spark, root, spec, log, [r[0] for r in keys.select(table_sink.key_hash(spec)).collect()]))
    if few > 18 or any("_slot" not in f for f in data.inputFiles()):
        raise AssertionError("only slots must be opened")
    found = mor.scan(data, deletes, spec.pk)
    return found.join(keys, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus")


@register("o7_progress_of_a_copy", """select 'public.orders' as "table", count(*) as "rows", true as complete from orders
union all select 'public.part', 0, false""")
def o7_copy(spark, d):
    """A snapshot that died in its second table: rows from the events tables, completion from the saved progress."""
    root = work_dir(spark, "o7")
    o, p = table(spark, d, "orders").select("o_orderkey"), table(spark, d, "part").select("p_partkey", "p_name")
    specs = [TableSpec.from_df(o, "orders", ["o_orderkey"]), TableSpec.from_df(p, "part", ["p_partkey"])]
    try:
        run_snapshot(spark, {"orders": o, "part": p.select("p_partkey")}, specs, root, _at(), "p")
    except AnalysisException:
        pass
    done = progress.load_progress(spark, root, "p")["snapshotted_tables"]
    out = None
    for s in specs:
        name = F.lit(s.name).alias("table")
        rows = event_sink.read_events(spark, root, s).select(name, F.lit("INSERT").alias("op"))
        marks = spark.createDataFrame([(s.name, "SNAPSHOT_TABLE_COMPLETE" if s.name in done else "STARTED")], "table string, op string")
        both = rows.unionByName(marks)
        out = both if out is None else out.unionByName(both)
    return snapshot_progress(out)


@register("k5_expired_history", """select (select count(*) from orders) as live, 2::bigint as commits_left""")
def k5_expired(spark, d):
    """Four deltas, a base, one more delta; then what the base made superfluous is removed and nothing else is."""
    root = work_dir(spark, "k5x")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"])

    def put(rows):
        commits.commit_tables(spark, root, None, table_sink.delta_writes(as_folded(rows, spec), spec), kind="delta")

    for n in range(4):
        put(o.filter(F.col("o_orderkey") % 4 == n))
    base = table_sink.compact(spark, root, spec)
    put(o.filter(F.col("o_orderkey") % 4 == 0))
    commits.expire(spark, root, base)
    left = [n for n in files.names(spark, f"{root}/{table_sink.data_name(spec)}") if n.startswith("_commit=")]
    live = table_sink.read_state(spark, root, spec).agg(F.count("*").alias("live"))
    return live.withColumn("commits_left", F.lit(len(left)).cast("bigint"))
