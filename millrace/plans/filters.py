"""Filters (F rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.apply import apply
from millrace.operators.envelope import dml_only, known_relations, tracked
from millrace.operators.fold import fold
from millrace.operators.latest import max_watermark
from millrace.operators.mor import between
from millrace.plans.fixtures import (
    BASE_BATCH, COMMITS, FEED, LOG_SPEC, SHOP, base_and_batch, commit_log, raw_feed, shop_feed, table,
)
from millrace.plans.registry import register
from millrace.sources.poll import poll
from millrace.spec import TableSpec, materializable


@register("f1_tracked_tables", f"with {SHOP}\nselect * from shop where \"table\" = 'public.lineitem'")
def f1(spark, d):
    return tracked(shop_feed(spark, d), ["public.lineitem", "public.part"])


# Tracked set as data: one table per user; those with any purchase are tracked.


@register("f1_tracked_table_set", """select event_id, 'public.u' || user_id as "table" from events
where user_id in (select user_id from events where event_type = 'purchase' and event_id % 3 = 0)""")
def f1_set(spark, d):
    e = table(spark, d, "events")
    name = F.concat(F.lit("public.u"), F.col("user_id"))
    wanted = e.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0)).select(name.alias("table")).distinct()
    return tracked(e.select("event_id", name.alias("table")), wanted)


@register("f2_known_relations", """select l_orderkey as relation_id, l_linenumber, l_partkey from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P')""")
def f2(spark, d):
    rel = table(spark, d, "orders").filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("relation_id"))
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("relation_id"), "l_linenumber", "l_partkey")
    return known_relations(rows, rel)


@register("f3_dml_only", f"with {FEED}\nselect xid, lsn, op, source_ts from dml")
def f3(spark, d):
    return dml_only(raw_feed(spark, d)).select("xid", "lsn", "op", "source_ts")


EDGE = "2024-01-16 00:00:00"


@register("f4_watermark_filter", f"""select event_id, user_id, ts from events
where event_id % 11 <> 0 and ts > timestamp '{EDGE}'""")
def f4(spark, d):
    e = table(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("ts"))
    return poll(e, "ts", F.lit(EDGE).cast("timestamp_ntz"))


@register("f4_watermark_advance", f"select event_type, max(ts) as watermark from events where ts > timestamp '{EDGE}' group by 1")
def f4_advance(spark, d):
    rows = poll(table(spark, d, "events"), "ts", F.lit(EDGE).cast("timestamp_ntz"))
    return max_watermark(rows, "ts", ["event_type"])


@register("f5_tables_without_key", """select 'public.orders' as "table", count(*) as n from orders
union all select 'public.part', count(*) from part""")
def f5(spark, d):
    """Rows per table that takes part in materialization; line items declare no key and stay a log."""
    keys = {"orders": ["o_orderkey"], "part": ["p_partkey"], "lineitem": []}
    specs = [TableSpec.from_df(table(spark, d, t), t, pk) for t, pk in keys.items()]
    out = None
    for s in materializable(specs):
        one = table(spark, d, s.lake_name).groupBy(F.lit(s.name).alias("table")).agg(F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@register("f6_commit_range", f"with {COMMITS}\nselect _commit, _seq, _op from clog where _commit > 9")
def f6(spark, d):
    return between(commit_log(spark, d), 9).select("_commit", "_seq", "_op")


@register("f7_unknown_deletes", f"""with {BASE_BATCH}
select user_id, slot, value, props from base s
where not exists (select 1 from batch b where b.user_id = s.user_id and b.slot = s.slot and b.op = 'D')""")
def f7(spark, d):
    """Only the deletes of the batch, many for keys the table never had."""
    base, batch = base_and_batch(spark, d)
    gone = fold(batch, LOG_SPEC).filter(F.col("op") == "D")
    strangers = gone.withColumn("user_id", -F.col("user_id") - 1)
    return apply(base, gone.unionByName(strangers), LOG_SPEC)
