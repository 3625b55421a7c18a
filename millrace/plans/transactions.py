"""Transactions (T rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import transactions as tx
from millrace.operators.envelope import to_events
from millrace.operators.fold import fold, live
from millrace.plans.fixtures import COMMITTED, FEED, LOG_SPEC, SHOP, fold_sql, raw_feed, shop_feed
from millrace.plans.registry import register


@register("t1_committed_only", f"with {COMMITTED}\nselect xid, pos, op from committed")
def t1(spark, d):
    return tx.committed_only(raw_feed(spark, d)).select("xid", "pos", "op")


@register("t1_open_transactions", f"""with {FEED}
select xid, pos, op from dml where xid <> 0 and xid not in (select xid from done)""")
def t1_open(spark, d):
    return tx.open_transactions(raw_feed(spark, d)).select("xid", "pos", "op")


# The fold's order key is (commit position, position); commit positions are far below 2^40.
REPLAY = f"{COMMITTED},\nr as (select *, commit_lsn * 1099511627776 + pos as ord from committed),\n" + fold_sql(
    "f", "r", order="ord")


@register("t2_replay_in_commit_order", f"with {REPLAY}\nselect user_id, slot, value, props from f where op <> 'D'")
def t2(spark, d):
    """State when transactions apply in commit order, which differs from arrival order."""
    ordered = tx.with_order(raw_feed(spark, d))
    events = to_events(ordered, LOG_SPEC, lsn="commit_lsn", seq="pos")
    return live(fold(events, LOG_SPEC, order=F.struct("_lsn", "_seq")), LOG_SPEC)


@register("t3_sequence_numbers", f"""with {COMMITTED}
select xid, pos, commit_lsn, row_number() over (partition by xid order by pos) as tx_seq from committed""")
def t3(spark, d):
    rows = tx.with_order(raw_feed(spark, d)).select("xid", "pos", "commit_lsn")
    return tx.statement_numbers(rows)


@register("t3_bulk_transaction", """select xid, pos, row_number() over (partition by xid order by pos) as tx_seq
from (select case when event_id % 3 = 0 then 0 else user_id end as xid, event_id as pos from events)""")
def t3_bulk(spark, d):
    """One transaction holds a third of all rows and is numbered in position ranges."""
    from millrace.plans.fixtures import table

    rows = table(spark, d, "events").select(
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).cast("bigint").alias("xid"),
        F.col("event_id").alias("pos"))
    return tx.statement_numbers(rows, ranges=50)


@register("t4_commit_time_stamp", f"with {COMMITTED}\nselect xid, pos, commit_ts as source_ts from committed")
def t4(spark, d):
    return tx.with_order(raw_feed(spark, d), stamp=True).select("xid", "pos", "source_ts")


@register("t4_begin_time_stamp", f"""with {FEED}
select dml.xid, pos, coalesce(begin_ts, source_ts) as source_ts from dml left join tx on tx.xid = dml.xid""")
def t4_begin(spark, d):
    return tx.stamp_begin(raw_feed(spark, d)).select("xid", "pos", "source_ts")


@register("t5_outside_transactions", f"with {FEED}\nselect pos, op, source_ts from dml where xid = 0")
def t5(spark, d):
    return tx.outside_transactions(raw_feed(spark, d)).select("pos", "op", "source_ts")


@register("t6_flushed_position", f"with {FEED}\nselect max(commit_lsn) as flushed_lsn, count(*) as transactions from done")
def t6(spark, d):
    return tx.flushed_position(raw_feed(spark, d))


@register("t7_table_sets", f"""with {SHOP}
select xid, string_agg(distinct "table", ',' order by "table") as tables, count(*) as "rows" from shop group by xid""")
def t7(spark, d):
    return tx.table_sets(shop_feed(spark, d))
