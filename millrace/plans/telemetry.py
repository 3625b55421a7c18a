"""Throughput, lag and backlog as queries (O rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.casts import lag_bytes, lsn_text, row_bytes
from millrace.operators import metrics
from millrace.plans.fixtures import COMMITTED, FEED, LOG, LOG_SPEC, SHOP, change_log, raw_feed, shop_feed, table
from millrace.plans.registry import register
from millrace.sources.snapshot import snapshot_all


@register("o1_rows_per_bucket", f"""with {LOG}
select date_trunc('hour', _ts) as bucket, _op, count(*) as n from log group by all""")
def o1(spark, d):
    return metrics.rows_per_bucket(change_log(spark, d), ["_op"])


@register("o2_bytes_per_bucket", f"""with {LOG}
select date_trunc('day', _ts) as bucket, count(*) as n, cast(sum(12 + case when value is null then 1 else 8 end
  + case when props is null then 1 else strlen(props) + 4 end) as bigint) as bytes from log group by all""")
def o2(spark, d):
    return metrics.rows_per_bucket(change_log(spark, d), [], "1 day", size=row_bytes(LOG_SPEC.schema))


@register("o3_replication_lag_bytes", f"""with {COMMITTED}
select (select max(lsn) from dml) - max(commit_lsn) as confirmed_lag, (select max(lsn) - min(lsn) from dml) as retained
from committed""")
def o3(spark, d):
    dml, done = F.col("op").isin("INSERT", "UPDATE", "DELETE"), F.col("op") == "COMMIT"
    marks = raw_feed(spark, d).agg(
        F.max(F.when(dml, F.col("lsn"))).alias("top"), F.min(F.when(dml, F.col("lsn"))).alias("low"),
        F.max(F.when(done, F.col("lsn"))).alias("done"))
    return marks.select(
        (F.col("top") - F.col("done")).alias("confirmed_lag"),
        lag_bytes(lsn_text(F.col("top")), lsn_text(F.col("low"))).alias("retained"))


@register("o4_materialization_lag", f"""with {SHOP},
w as (select "table", max(lsn) as events_lsn from shop group by 1),
m as (select "table", max(lsn) as l from shop where op = 'INSERT' and xid % 7 < 5 and "table" = 'public.orders' group by 1)
select w."table", events_lsn, coalesce(l, 0) as materialized_lsn, events_lsn - coalesce(l, 0) as lag from w left join m using ("table")""")
def o4(spark, d):
    feed = shop_feed(spark, d).withColumnRenamed("lsn", "_lsn")
    done = feed.filter((F.col("op") == "INSERT") & (F.col("xid") % 7 < 5) & (F.col("table") == "public.orders"))
    return metrics.materialization_lag(feed, done)


NOW = "2024-02-01 00:00:00"


@register("o5_watermark_lag", f"""select event_type, cast(floor(epoch_us(timestamp '{NOW}' - max(ts)) / 1000000.0) as bigint) as lag_seconds
from events group by 1""")
def o5(spark, d):
    return metrics.watermark_lag(table(spark, d, "events"), "ts", F.lit(NOW).cast("timestamp_ntz"), "event_type")


@register("o6_processing_delay", f"""with {FEED},
x as (select op, cast(floor(epoch_us(proc_ts) / 1000000.0) - floor(epoch_us(source_ts) / 1000000.0) as bigint) as d from dml)
select op, count(*) as n, min(d) as min_delay, max(d) as max_delay,
  quantile_disc(d, 0.5) as p50_delay, quantile_disc(d, 0.95) as p95_delay from x group by op""")
def o6(spark, d):
    feed = raw_feed(spark, d)
    return metrics.delays(feed.filter(F.col("table").isNotNull()), "op")


@register("o7_snapshot_progress", """select 'public.orders' as "table", count(*) as "rows", true as complete from orders
union all select 'public.customer', count(*), true from customer
union all select 'public.part', count(*), false from part""")
def o7(spark, d):
    """Two tables complete, one still copying."""
    at = F.lit("2024-06-01").cast("timestamp")
    feed = snapshot_all({t: table(spark, d, t) for t in ("orders", "customer", "part")}, at)
    running = feed.filter(~((F.col("table") == "public.part") & (F.col("op") != "INSERT")) & F.col("table").isNotNull())
    return metrics.snapshot_progress(running)


@register("o8_latency_histogram", "select event_type, " + ", ".join(
    f"count(*) filter (where value / 4 <= {b}) as le_{str(b).replace('.', '_')}" for b in metrics.FLUSH_BOUNDS
) + ", count(*) as total from events group by 1")
def o8(spark, d):
    e = table(spark, d, "events").withColumn("latency", F.col("value") / 4)
    return metrics.histogram(e, "latency", metrics.FLUSH_BOUNDS, "event_type")


@register("o9_backlog", """select 'public.u' || user_id as "table",
  count(*) filter (where last_seq is null or event_id > last_seq) as backlog
from events left join (select user_id, max(event_id) as last_seq from events where event_type = 'purchase' and event_id % 2 = 0 group by 1) p using (user_id)
group by 1""")
def o9(spark, d):
    name = F.concat(F.lit("public.u"), F.col("user_id")).alias("table")
    e = table(spark, d, "events")
    progress = e.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 2 == 0)).groupBy(name).agg(
        F.max("event_id").alias("last_seq"))
    return metrics.backlog(e.select(name, F.col("event_id").alias("_seq")), progress)
