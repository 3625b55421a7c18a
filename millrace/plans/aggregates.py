"""Aggregations, sorts, limits (A rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import metrics, mor
from millrace.operators.latest import latest_per_key, max_watermark, table_watermarks
from millrace.operators.verify import diff_sample, table_diff
from millrace.plans.checks import DIFF, diff_pair
from millrace.plans.fixtures import COMMITS, FEED, LOG, SHOP, change_log, commit_log, raw_feed, shop_feed, table
from millrace.plans.folding import PAIR, mor_pair
from millrace.plans.registry import register
from millrace.sinks.commits import with_previous
from millrace.sinks.progress import latest_progress


@register("a1_latest_per_key", """select user_id, event_id, ts, event_type, value, props from events
qualify row_number() over (partition by user_id order by date_trunc('hour', ts) desc, event_id desc) = 1""")
def a1(spark, d):
    """Watermark by hour, so ties are common; the event number breaks them."""
    e = table(spark, d, "events").withColumn("h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return latest_per_key(e, ["user_id"], ["h", "event_id"]).drop("h")


@register("a2_max_watermark", """select 'public.u' || user_id as "table",
  coalesce(max(ts) filter (where event_type = 'purchase'), timestamp '2024-01-01') as watermark from events group by 1""")
def a2(spark, d):
    e = table(spark, d, "events").withColumn("table", F.concat(F.lit("public.u"), F.col("user_id")))
    per = max_watermark(e.filter(F.col("event_type") == "purchase"), "ts", ["table"])
    return table_watermarks(e.select("table").distinct(), per, "2024-01-01 00:00:00")


@register("a3_max_lsn_per_table", f"with {SHOP}\nselect \"table\", max(lsn) as max_lsn from shop group by 1")
def a3(spark, d):
    return shop_feed(spark, d).groupBy("table").agg(F.max("lsn").alias("max_lsn"))


@register("a4_counts_by_table_op", f"with {SHOP}\nselect \"table\", op, count(*) as n from shop group by all")
def a4(spark, d):
    return metrics.counts(shop_feed(spark, d), "table", "op")


@register("a4_counts_with_control_rows", f"""with {FEED}
select "table", op, count(*) as n from dml group by all
union all select null, 'BEGIN', count(*) from tx union all select null, 'COMMIT', count(*) from done""")
def a4_control(spark, d):
    return metrics.counts(raw_feed(spark, d), "table", "op")


@register("a5_latest_checkpoint", """select user_id % 20 as pipeline_id, max(ts) as updated_at, arg_max(event_id, ts) as lsn
from events group by 1""")
def a5(spark, d):
    saves = table(spark, d, "events").select(
        (F.col("user_id") % 20).alias("pipeline_id"), F.col("ts").alias("updated_at"), F.col("event_id").alias("lsn"))
    return latest_progress(saves)


@register("a6_ordered_events", f"with {LOG}\nselect _seq, _op, user_id, slot, value from log order by _seq")
def a6(spark, d):
    return change_log(spark, d).select("_seq", "_op", "user_id", "slot", "value").orderBy("_seq")


@register("a7_first_differences", f"""with {DIFF}
select user_id, slot, category from diff
qualify row_number() over (partition by category order by user_id, slot) <= 10""")
def a7(spark, d):
    expected, actual = diff_pair(spark, d)
    return diff_sample(table_diff(expected, actual, ["user_id", "slot"]), ["user_id", "slot"], 10)


@register("a8_commit_totals", f"""with {PAIR}
select _commit, coalesce(a.n, 0) as data_rows, b.n as delete_rows
from (select _commit, count(*) as n from deletes group by 1) b left join (select _commit, count(*) as n from data group by 1) a using (_commit)""")
def a8(spark, d):
    deletes, data = mor_pair(spark, d)
    return mor.totals(data, deletes)


@register("a9_row_count", """select 'orders' as "table", count(*) as n from orders union all select 'lineitem', count(*) from lineitem
union all select 'events', count(*) from events""")
def a9(spark, d):
    out = None
    for t in ("orders", "lineitem", "events"):
        one = table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@register("a10_commit_history", f"""with {COMMITS},
c as (select _commit, 'activity_events' as "table", 'append' as kind, max(_ts) as committed_at, max(_seq) as mark from clog group by 1
  union all select _commit, 'activity', 'overwrite', max(_ts), max(_seq) from clog where _commit % 2 = 1 group by 1)
select *, lag(_commit) over (partition by "table" order by _commit) as previous from c""")
def a10(spark, d):
    """Every commit appends to the change log, every second one updates the table."""
    per = commit_log(spark, d).groupBy("_commit").agg(F.max("_ts").alias("committed_at"), F.max("_seq").alias("mark"))
    log = per.withColumns({"table": F.lit("activity_events"), "kind": F.lit("append")}).unionByName(
        per.filter(F.col("_commit") % 2 == 1).withColumns({"table": F.lit("activity"), "kind": F.lit("overwrite")}))
    return with_previous(log.select("_commit", "table", "kind", "committed_at", "mark"))
