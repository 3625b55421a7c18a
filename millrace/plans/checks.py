"""Verification, replay checks, time travel (V rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import mor
from millrace.operators.apply import apply
from millrace.operators.fold import fold, live
from millrace.operators.verify import diff_summary, missing_keys, order_ties, table_diff
from millrace.plans.fixtures import HALF, LOG, LOG_SPEC, STATE, base_and_batch, change_log, fold_sql, half
from millrace.plans.folding import PAIR, mor_pair
from millrace.plans.registry import register

PK = ["user_id", "slot"]

# A damaged copy of the state: some keys removed, some added, some values changed.
DIFF = f"""{STATE},
actual as (
  select user_id, slot, case when (user_id * 7 + slot) % 31 = 0 then coalesce(value, 0) + 1 else value end as value, props
  from state where (user_id * 7 + slot) % 50 <> 0
  union all
  select user_id, cast(slot + 100 as integer), value, props from state where (user_id * 7 + slot) % 41 = 0),
diff as (
  select coalesce(e.user_id, a.user_id) as user_id, coalesce(e.slot, a.slot) as slot,
    case when a.user_id is null then 'missing' when e.user_id is null then 'extra' else 'wrong' end as category
  from state e full outer join actual a on e.user_id = a.user_id and e.slot = a.slot
  where a.user_id is null or e.user_id is null or e.value is distinct from a.value or e.props is distinct from a.props)"""


def diff_pair(spark, d):
    state = live(fold(change_log(spark, d), LOG_SPEC), LOG_SPEC)
    key = F.col("user_id") * 7 + F.col("slot")
    kept = state.filter(key % 50 != 0).withColumn(
        "value", F.when(key % 31 == 0, F.coalesce("value", F.lit(0.0)) + 1).otherwise(F.col("value")))
    added = state.filter(key % 41 == 0).withColumn("slot", (F.col("slot") + 100).cast("int"))
    return state, kept.unionByName(added)


@register("v1_table_diff", f"with {DIFF}\nselect * from diff")
def v1(spark, d):
    return table_diff(*diff_pair(spark, d), PK)


@register("v2_diff_summary", f"""with {DIFF}
select (select count(*) from state) as expected_rows, (select count(*) from actual) as actual_rows,
  count(*) filter (where category = 'missing') as missing_rows, count(*) filter (where category = 'extra') as extra_rows,
  count(*) filter (where category = 'wrong') as wrong_rows, count(*) = 0 as pass from diff""")
def v2(spark, d):
    return diff_summary(*diff_pair(spark, d), PK)


@register("v3_flush_completeness", """select o_orderkey from orders
where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def v3(spark, d):
    from millrace.plans.fixtures import table

    log = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return missing_keys(table(spark, d, "orders"), log, ["o_orderkey"])


@register("v4_replay_equals_table", f"""with {STATE}
select count(*) as expected_rows, count(*) as actual_rows, cast(0 as bigint) as missing_rows, cast(0 as bigint) as extra_rows,
  cast(0 as bigint) as wrong_rows, true as pass from state""")
def v4(spark, d):
    """The whole log folded at once against the table built in two steps."""
    base, batch = base_and_batch(spark, d)
    return diff_summary(
        live(fold(change_log(spark, d), LOG_SPEC), LOG_SPEC), apply(base, fold(batch, LOG_SPEC), LOG_SPEC), PK)


@register("v4_order_key_is_unique", f"with {LOG}\nselect count(*) - count(distinct _seq) as ties from log")
def v4_ties(spark, d):
    return order_ties(change_log(spark, d), ["_seq"]).agg(F.count("*").alias("ties"))


@register("v5_state_as_of_sequence", f"""with {LOG},\n{fold_sql('f', 'log', where=f'_seq < {HALF}')}
select user_id, slot, value, props from f where op <> 'D'""")
def v5(spark, d):
    return live(fold(change_log(spark, d).filter(F.col("_seq") < half(spark, d)), LOG_SPEC), LOG_SPEC)


@register("v5_state_as_of_commit", f"""with {PAIR}
select d.user_id, d.slot, d.value, d.props from data d where d._commit <= 30 and not exists (
  select 1 from deletes x where x.user_id = d.user_id and x.slot = d.slot and x._commit > d._commit and x._commit <= 30)""")
def v5_commit(spark, d):
    deletes, data = mor_pair(spark, d)
    return mor.scan(data, deletes, PK, as_of=30)
