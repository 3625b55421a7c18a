"""Writers (K rows). Each query writes from the given tables into the shared work folder and reads back."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from millrace.operators.fold import as_folded, fold
from millrace.plans.fixtures import BASE_BATCH, LOG, LOG_SPEC, base_and_batch, change_log, fold_sql, table
from millrace.plans.folding import APPLIED
from millrace.plans.registry import register
from millrace.session import work_dir
from millrace.sinks import commits, events as event_sink, progress, tables as table_sink
from millrace.spec import TableSpec
from dataclasses import replace

EVENT_COLS = ["_op", "_lsn", "_ts", "_seq", "_unchanged_cols", *LOG_SPEC.columns]


def _events(spark, d):
    return change_log(spark, d).select(*EVENT_COLS)


def _plain(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "_ts" else F.col(c) for c in EVENT_COLS])


@register("k1_append_events", f"with {LOG}\nselect _op, _lsn, _ts, _seq, _unchanged_cols, user_id, slot, value, props from log")
def k1(spark, d):
    root = work_dir(spark, "k1")
    rows = _events(spark, d)
    for batch in range(3):
        event_sink.append_events(rows.filter(F.col("_seq") % 3 == batch), LOG_SPEC, root, batch)
    return _plain(event_sink.read_events(spark, root, LOG_SPEC))


@register("k2_partitioned_events", f"""with {LOG}
select cast(datediff('day', date '1970-01-01', cast(_ts as date)) as integer) as _ts_day, _op, count(*) as n from log group by all""")
def k2(spark, d):
    """Counts by the partition column as it is stored in the folder names."""
    root = work_dir(spark, "k2")
    event_sink.append_events(_events(spark, d), LOG_SPEC, root, 0)
    return event_sink.read_events(spark, root, LOG_SPEC).groupBy("_ts_day", "_op").agg(F.count("*").alias("n"))


@register("k2_custom_partition", f"with {LOG}\nselect _op, _seq - _seq % 500 as _seq_truncate, count(*) as n from log group by all")
def k2_custom(spark, d):
    root = work_dir(spark, "k2c")
    event_sink.append_events(_events(spark, d), LOG_SPEC, root, 0, exprs=["_op", "truncate[500](_seq)"])
    return event_sink.read_events(spark, root, LOG_SPEC).groupBy("_op", "_seq_truncate").agg(F.count("*").alias("n")).select(
        "_op", F.col("_seq_truncate").cast("bigint").alias("_seq_truncate"), "n")


BUCKETED = replace(LOG_SPEC, partition=("bucket[4](user_id)",))


@register("k3_merge_table", f"with {APPLIED}\nselect * from applied")
def k3(spark, d):
    """Base as commit 0, the batch merged as commit 1: only touched partitions are rewritten."""
    root = work_dir(spark, "k3")
    base, batch = base_and_batch(spark, d)
    for commit, change in enumerate((as_folded(base, BUCKETED), fold(batch, BUCKETED))):
        change = change.persist(StorageLevel.MEMORY_AND_DISK)
        table_sink.merge_table(change, BUCKETED, root, commit)
        change.unpersist()
    return table_sink.read_versions(spark, root, BUCKETED)


@register("k3_version_before_merge", f"with {BASE_BATCH}\nselect * from base")
def k3_before(spark, d):
    """The earlier version stays readable after a merge."""
    root = work_dir(spark, "k3v")
    base, batch = base_and_batch(spark, d)
    for commit, change in enumerate((as_folded(base, BUCKETED), fold(batch, BUCKETED))):
        change = change.persist(StorageLevel.MEMORY_AND_DISK)
        table_sink.merge_table(change, BUCKETED, root, commit)
        change.unpersist()
    return table_sink.read_versions(spark, root, BUCKETED, as_of=0)


@register("k4_delta_write", f"""with {LOG},\n{fold_sql('f', 'log')}
select 'activity/data' as "table", cast(0 as bigint) as _commit, count(*) as n from f where op <> 'D'
union all select 'activity/deletes', 0, count(*) from f""")
def k4(spark, d):
    root = work_dir(spark, "k4")
    folded = fold(change_log(spark, d), LOG_SPEC).persist(StorageLevel.MEMORY_AND_DISK)
    writes = table_sink.delta_writes(folded, LOG_SPEC)
    commits.commit_tables(spark, root, 0, writes, kind="delta")
    folded.unpersist()
    data, deletes = table_sink.read_parts(spark, root, LOG_SPEC)
    parts = [df.select(F.lit(n).alias("table"), "_commit") for n, df in (
        (table_sink.data_name(LOG_SPEC), data), (table_sink.deletes_name(LOG_SPEC), deletes))]
    return parts[0].unionByName(parts[1]).groupBy("table", "_commit").agg(F.count("*").alias("n"))


def _two_tables(spark, d, lo):
    o = table(spark, d, "orders").filter(F.col("o_orderkey") % 3 == lo).select("o_orderkey", "o_orderstatus")
    li = table(spark, d, "lineitem").filter(F.col("l_orderkey") % 3 == lo).select("l_orderkey", "l_linenumber")
    return {"orders": o, "lineitem": li}


@register("k5_atomic_commit", """select 'orders' as "table", o_orderkey % 3 as _commit, count(*) as n from orders where o_orderkey % 3 < 2 group by all
union all select 'lineitem', l_orderkey % 3, count(*) from lineitem where l_orderkey % 3 < 2 group by all""")
def k5(spark, d):
    """Two commits of two tables; a third stops after writing both, before it is published."""
    root = work_dir(spark, "k5")
    for n in (0, 1):
        commits.commit_tables(spark, root, n, _two_tables(spark, d, n))
    for name, df in _two_tables(spark, d, 2).items():
        commits.write_part(df, root, name, 2)
    if commits.last_commit(spark, root) != 1:
        raise AssertionError("what was not published must not be seen")
    schemas = {n: df.schema for n, df in _two_tables(spark, d, 0).items()}
    out = None
    for name, schema in schemas.items():
        one = commits.read_table(spark, root, name, schema).groupBy(F.lit(name).alias("table"), "_commit").agg(
            F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@register("k6_idempotent_retry", """select o_orderkey % 3 as _commit, count(*) as n, count(distinct o_orderkey) as keys
from orders group by 1""")
def k6(spark, d):
    """Commit 1 fails half way, runs again, and is then replayed once more; so is it later under another number."""
    root = work_dir(spark, "k6")
    for n in (0, 1, 2):
        writes = _two_tables(spark, d, n)
        if n == 1:
            commits.write_part(writes["orders"].filter(F.col("o_orderkey") % 2 == 0), root, "orders", n)
            commits.commit_tables(spark, root, n, writes, source=f"shop:{n}")
        commits.commit_tables(spark, root, n, writes, source=f"shop:{n}")
    if commits.commit_tables(spark, root, 3, _two_tables(spark, d, 1), source="shop:1") != 1:
        raise AssertionError("a source that is there already must keep its commit")
    rows = commits.read_table(spark, root, "orders", _two_tables(spark, d, 0)["orders"].schema)
    return rows.groupBy("_commit").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("keys"))


@register("k7_target_file_size", "select count(*) as \"rows\", cast(0 as bigint) as files_over_target from lineitem")
def k7(spark, d):
    """Files roll at a row limit derived from the average row size and the target size."""
    from millrace.functions.casts import row_bytes

    li = table(spark, d, "lineitem")
    total, n = li.agg(F.sum(row_bytes(li.schema)), F.count("*")).first()
    limit = commits.rows_per_file(total / n, target_bytes=256 << 10)
    root = work_dir(spark, "k7")
    commits.write_part(li, root, "lineitem", 0, rows_per_file=limit)
    files = spark.read.parquet(f"{root}/lineitem").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > limit).alias("files_over_target"))


@register("k8_flush_triggers", "select cast(4 as bigint) as flushes, count(*) as \"rows\" from orders")
def k8(spark, d):
    """A stream cut into flushes by the amount of input per trigger."""
    root = work_dir(spark, "k8")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for i in range(4):
        o.filter(F.col("o_orderkey") % 4 == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")

    def flush(batch, batch_id):
        commits.commit_tables(batch.sparkSession, root, batch_id, {"orders": batch})

    (stream.writeStream.foreachBatch(flush).option("checkpointLocation", f"{root}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    rows = commits.read_table(spark, root, "orders", o.schema)
    return rows.agg(F.countDistinct("_commit").alias("flushes"), F.count("*").alias("rows"))


@register("k9_create_if_missing", "select o_orderkey, o_orderstatus from orders")
def k9(spark, d):
    root = work_dir(spark, "k9")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    specs = [TableSpec.from_df(o, "orders", ["o_orderkey"], partition=("o_orderstatus",))]
    first, second = (table_sink.ensure_tables(spark, root, specs) for _ in range(2))
    if first != ["public.orders"] or second or table_sink.read_state(spark, root, specs[0]).count():
        raise AssertionError("the table must be created once, empty")
    writes = table_sink.delta_writes(as_folded(o, specs[0]), specs[0])
    commits.commit_tables(spark, root, 1, writes, kind="delta", partition_by=table_sink.partition_map(specs[0]))
    return table_sink.read_state(spark, root, specs[0])


@register("k10_progress_upsert", """select 'p' || user_id as pipeline_id, arg_max(event_type || ':' || event_id, ts) as progress,
  max(ts) as updated_at from events group by 1""")
def k10(spark, d):
    saves = table(spark, d, "events").select(
        F.concat(F.lit("p"), F.col("user_id")).alias("pipeline_id"),
        F.concat_ws(":", "event_type", "event_id").alias("progress"), F.col("ts").alias("updated_at"))
    return progress.latest_progress(saves)
