"""Fold, apply, merge-on-read, joins (M and J rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import mor, replay
from millrace.operators.apply import affected, apply, resolve, restrict_to, route_deletes, touched_partitions, unresolved
from millrace.operators.fold import fold, live
from millrace.plans.fixtures import (
    BASE_BATCH, COMMITS, LOG, LOG_SPEC, STATE, base_and_batch, change_log, commit_log,
    fold_sql, table,
)
from millrace.plans.registry import register
from millrace.session import work_dir
from millrace.sinks import commits, tables as table_sink
from millrace.spec import TableSpec

RESOLVED = f"""{BASE_BATCH},
resolved as (
  select b.user_id, b.slot, b.op, b.seq,
         case when b.known_value then b.value else s.value end as value,
         case when b.known_props then b.props else s.props end as props
  from batch b left join base s using (user_id, slot))"""

APPLIED = f"""{RESOLVED},
applied as (
  select user_id, slot, value, props from resolved where op <> 'D'
  union all
  select user_id, slot, value, props from base s
  where not exists (select 1 from batch b where b.user_id = s.user_id and b.slot = s.slot))"""


@register("m1_fold_state", f"with {LOG},\n{fold_sql('f', 'log')}\nselect * from f")
def m1(spark, d):
    return fold(change_log(spark, d), LOG_SPEC)


@register("m1_fold_live_rows", f"with {STATE}\nselect * from state")
def m1_live(spark, d):
    return live(fold(change_log(spark, d), LOG_SPEC), LOG_SPEC)


@register("m2_resolve_unchanged", f"with {RESOLVED}\nselect * from resolved")
def m2(spark, d):
    base, batch = base_and_batch(spark, d)
    out = resolve(fold(batch, LOG_SPEC), base, LOG_SPEC)
    return out.select("user_id", "slot", "op", "seq", "value", "props")


@register("m3_apply", f"with {APPLIED}\nselect * from applied")
def m3(spark, d):
    base, batch = base_and_batch(spark, d)
    return apply(base, fold(batch, LOG_SPEC), LOG_SPEC)


@register("m3_apply_narrow", f"with {APPLIED}\nselect * from applied")
def m3_narrow(spark, d):
    base, batch = base_and_batch(spark, d)
    return apply(base, fold(batch, LOG_SPEC), LOG_SPEC, narrow=True)


@register("m3_apply_null_safe", f"with {APPLIED}\nselect * from applied")
def m3_null_safe(spark, d):
    base, batch = base_and_batch(spark, d)
    return apply(base, fold(batch, LOG_SPEC), LOG_SPEC, null_safe=True)


@register("m4_split_deletes_data", f"""with {LOG},\n{fold_sql('f', 'log')}
select 'delete' as kind, user_id, slot, cast(null as double) as value, cast(null as varchar) as props from f
union all
select 'data', user_id, slot, value, props from f where op <> 'D'""")
def m4(spark, d):
    deletes, data = mor.split(fold(change_log(spark, d), LOG_SPEC), LOG_SPEC)
    return data.select(F.lit("data").alias("kind"), "*").unionByName(
        deletes.select(F.lit("delete").alias("kind"), "*"), allowMissingColumns=True)


# Per commit: fold of that commit's events, unchanged columns filled from the state before it.


def mor_pair(spark, d):
    """Data and deletes of every commit at once.

    The state before a commit is what all earlier commits fold to; a column a
    commit leaves open takes the last known value of the key's earlier commits.
    """
    per_commit = fold(
        commit_log(spark, d),
        TableSpec.of(LOG_SPEC.name, [("_commit", "bigint"), ("user_id", "bigint"), ("slot", "integer"),
                                     ("value", "double precision"), ("props", "text")],
                     pk=["_commit", "user_id", "slot"]))
    # One row per key and commit, so the running last value sees at most as many rows as commits.
    from pyspark.sql import Window

    past = Window.partitionBy("user_id", "slot").orderBy("_commit").rowsBetween(Window.unboundedPreceding, 0)

    def fill(c):
        # A known null is a value too: wrap it.
        return F.last(F.when(F.col(f"known_{c}"), F.struct(F.col(c).alias("v"))), ignorenulls=True).over(past)["v"]

    filled = per_commit.withColumns({c: fill(c) for c in ("value", "props")})
    return mor.split(filled, LOG_SPEC, commit="_commit")


PAIR = f"""{COMMITS},
{fold_sql('cf', 'clog', by='_commit, ')},
deletes as (select _commit, user_id, slot from cf),
data as (
  select c._commit, c.user_id, c.slot,
    (select arg_max_null(l.value, l._seq) from clog l where l.user_id = c.user_id and l.slot = c.slot
       and l._commit <= c._commit and (l._op <> 'U' or not list_contains(string_split(coalesce(l._unchanged_cols, ''), ','), 'value'))) as value,
    (select arg_max_null(l.props, l._seq) from clog l where l.user_id = c.user_id and l.slot = c.slot
       and l._commit <= c._commit and (l._op <> 'U' or not list_contains(string_split(coalesce(l._unchanged_cols, ''), ','), 'props'))) as props
  from cf c where c.op <> 'D')"""

SCAN = """select d.user_id, d.slot, d.value, d.props from data d
where not exists (select 1 from deletes x where x.user_id = d.user_id and x.slot = d.slot
                  and x._commit > d._commit)"""


@register("m5_merge_on_read_scan", f"with {PAIR}\n{SCAN}")
def m5(spark, d):
    deletes, data = mor_pair(spark, d)
    return mor.scan(data, deletes, LOG_SPEC.pk)


@register("m5_null_keys", """with e as (select *, case when user_id % 5 <> 0 then user_id end as k, event_id % 3 as part from events),
last as (select k, arg_max(event_id, event_id) as event_id from e group by k)
select e.k, e.event_id, e.value from e join last on e.event_id = last.event_id""")
def m5_null_keys(spark, d):
    """Three commits write each key anew; a fifth of the rows share the null key, which is a key like any other."""
    e = table(spark, d, "events").select(
        F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("k"), "event_id", "value",
        F.floor(F.col("event_id") * 3 / table(spark, d, "events").agg(F.max("event_id") + 1).scalar()).alias("_commit"))
    data = e.groupBy("k", "_commit").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))
    deletes = data.select("_commit", "k")
    return mor.scan(data.select("_commit", "k", "event_id", "value"), deletes, ["k"], nullable=["k"])


@register("m6_affected_rows", f"""with {BASE_BATCH}
select s.* from base s where exists (select 1 from batch b where b.user_id = s.user_id and b.slot = s.slot)""")
def m6(spark, d):
    base, batch = base_and_batch(spark, d)
    return affected(base, fold(batch, LOG_SPEC), LOG_SPEC.pk)


# Partition column for routing: the user's residue class.
PARTED = f"""{BASE_BATCH},
pbase as (select *, cast(floor(value / 40) as integer) as band from base),
pbatch as (select *, cast(floor(value / 40) as integer) as band from batch),
touched as (
  select band from pbatch where op <> 'D'
  union
  select s.band from pbase s join pbatch b using (user_id, slot))"""


def _parted(spark, d):
    base, batch = base_and_batch(spark, d)
    band = F.floor(F.col("value") / 40).cast("int")
    return base.withColumn("band", band), fold(batch, LOG_SPEC).withColumn("band", band)


@register("m7_touched_partitions", f"with {PARTED}\nselect band from touched")
def m7(spark, d):
    base, folded = _parted(spark, d)
    return touched_partitions(base, folded, LOG_SPEC, ["band"])


@register("m7_rows_to_rewrite", f"""with {PARTED}
select user_id, slot, value, props, band from pbase
where exists (select 1 from touched t where t.band is not distinct from pbase.band)""")
def m7_rows(spark, d):
    base, folded = _parted(spark, d)
    return restrict_to(base, touched_partitions(base, folded, LOG_SPEC, ["band"]), ["band"])


@register("m8_route_deletes", f"""with {PARTED}
select s.user_id, s.slot, s.band from pbase s join pbatch b using (user_id, slot) where b.op = 'D'""")
def m8(spark, d):
    base, folded = _parted(spark, d)
    return route_deletes(folded, base, LOG_SPEC, ["band"])


ORDERS_SPEC = TableSpec.of(
    "public.orders", [("o_orderkey", "bigint", False), ("o_orderstatus", "text"), ("o_totalprice", "double precision")],
    pk=["o_orderkey"])
LINES_SPEC = TableSpec.of(
    "public.order_lines", [("l_orderkey", "bigint", False), ("lines", "bigint"), ("quantity", "bigint")],
    pk=["l_orderkey"])


def _shop_events(spark, d, spec):
    """Per order: an insert, then for some an update of the status or a delete."""
    if spec is ORDERS_SPEC:
        rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
        changed, gone = F.lit("Z"), F.col("o_orderstatus") == "P"
        update = rows.filter(F.col("o_orderstatus") == "F").withColumn("o_orderstatus", changed).withColumn(
            "o_totalprice", F.lit(None).cast("double"))
        left_out, delete = "o_totalprice", rows.filter(gone)
    else:
        rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
            F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
        update = rows.filter(F.col("lines") > 4).withColumn("lines", F.lit(None).cast("bigint")).withColumn(
            "quantity", F.lit(0).cast("bigint"))
        left_out, delete = "lines", rows.filter(F.col("lines") == 1)

    def ev(df, op, seq, left=None):
        return df.withColumns({"_op": F.lit(op), "_lsn": F.lit(seq).cast("bigint"),
                               "_seq": F.col(spec.pk[0]) * 10 + seq, "_unchanged_cols": F.lit(left).cast("string"),
                               "_ts": F.lit("2024-01-01").cast("timestamp")})

    return ev(rows, "I", 1).unionByName(ev(update, "U", 2, left_out)).unionByName(ev(delete, "D", 3))


@register("m9_materialize_cycle", """
select 'orders' as "table", o_orderkey as k, case when o_orderstatus = 'F' then 'Z' else o_orderstatus end as a,
       o_totalprice as b from orders where o_orderstatus <> 'P'
union all
select 'order_lines', l_orderkey, cast(count(*) as varchar),
       cast(case when count(*) > 4 then 0 else sum(cast(l_quantity as bigint)) end as double)
from lineitem group by l_orderkey having count(*) <> 1""")
def m9(spark, d):
    """Two tables' events in two event commits, two cycles, then one repeated cycle that does nothing."""
    from millrace.sinks.events import prepare_events
    from millrace.streaming.pipeline import materialize

    events, root = work_dir(spark, "m9-events"), work_dir(spark, "m9-tables")
    specs = [ORDERS_SPEC, LINES_SPEC]
    for n, cond in ((0, F.col("_lsn") < 2), (1, F.col("_lsn") >= 2)):
        writes, parts = {}, {}
        for s in specs:
            writes[s.events_name], parts[s.events_name] = prepare_events(_shop_events(spark, d, s).filter(cond), s)
        commits.commit_tables(spark, events, n, writes, partition_by=parts)
        materialize(spark, specs, events, root, upto=n)
    if materialize(spark, specs, events, root) is not None:
        raise AssertionError("a repeated cycle must find nothing to do")
    o = table_sink.read_state(spark, root, ORDERS_SPEC).select(
        F.lit("orders").alias("table"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("a"),
        F.col("o_totalprice").alias("b"))
    li = table_sink.read_state(spark, root, LINES_SPEC).select(
        F.lit("order_lines").alias("table"), F.col("l_orderkey").alias("k"), F.col("lines").cast("string").alias("a"),
        F.col("quantity").cast("double").alias("b"))
    return o.unionByName(li)


@register("m10_compact", f"with {PAIR}\n{SCAN}")
def m10(spark, d):
    deletes, data = mor_pair(spark, d)
    packed = mor.compact(data, deletes, LOG_SPEC.pk, commit=1 << 40)
    return mor.scan(packed, deletes, LOG_SPEC.pk)


# -- replays ---------------------------------------------------------------


@register("j1_replay_by_secondary_key", f"""with {LOG},
l as (select _seq, _op, user_id * 7 + slot as id, cast(value as bigint) as value from log)
select id * 10 + 3 as seq, arg_max_null(value, _seq) filter (where _op <> 'D') as value
from l group by id
having max(_seq) filter (where _op = 'I') > coalesce(max(_seq) filter (where _op = 'D'), -1)""")
def j1(spark, d):
    ident = F.col("user_id") * 7 + F.col("slot")
    log = change_log(spark, d).select(
        "_op", "_seq", ident.alias("id"), F.when(F.col("_op") != "D", ident * 10 + 3).alias("seq"),
        F.round("value").cast("bigint").alias("value"))
    return replay.replay_by_id(log)


OPS = """ops as (
  select event_id as id, case event_type when 'signup' then 'insert' when 'error' then 'delete' else 'update' end as op,
         user_id * 7 + event_id % 7 as seq,
         case when event_id % 5 = 0 then null else event_id * 3 end as value
  from events)"""


def operation_log(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.when(kind == "signup", "insert").when(kind == "error", "delete").otherwise("update").alias("op"),
        (F.col("user_id") * 7 + F.col("event_id") % 7).alias("seq"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id") * 3).alias("value"))


@register("j2_replay_operation_log", f"""with {OPS},
k as (select seq, max(id) filter (where op = 'insert' and value is not null) as i,
             max(id) filter (where op = 'delete') as x from ops group by seq)
select ops.seq, arg_max(value, id) as value from ops join k using (seq)
where k.i is not null and (k.x is null or k.i > k.x) and op <> 'delete' and value is not null
group by ops.seq""")
def j2(spark, d):
    return replay.replay_ops(operation_log(spark, d))


@register("j3_relation_as_of", f"""with {LOG},
versions as (select slot as rel, _lsn - 5 as at, _seq as version from log where _op = 'I'),
ev as (select slot as rel, _lsn as at, _seq from log)
select e._seq, e.rel, e.at, v.version from ev e asof left join versions v on e.rel = v.rel and e.at >= v.at""")
def j3(spark, d):
    log = change_log(spark, d)
    versions = log.filter(F.col("_op") == "I").select(
        F.col("slot").alias("rel"), (F.col("_lsn") - 5).alias("at"), F.col("_seq").alias("version"))
    ev = log.select("_seq", F.col("slot").alias("rel"), F.col("_lsn").alias("at"))
    return replay.as_of(ev, versions, "rel", "at", ["version"])


FAR = 1_000_000_000_000_000


@register("j3_snapshot_and_log", f"""with {LOG},
log2 as (select *, case when _seq % 50 = 0 then 0 else {FAR} + _lsn end as place from log),
versions as (select slot as rel, max(_seq) as version, place from log2 where _op = 'I' group by slot, place)
select e._seq, e.slot as rel, e.place, v.version from log2 e asof left join versions v on e.slot = v.rel and e.place >= v.place""")
def j3_far(spark, d):
    """A few snapshot rows at position 0, all others near 10^15."""
    at = F.when(F.col("_seq") % 50 == 0, F.lit(0)).otherwise(F.col("_lsn") + F.lit(FAR)).cast("bigint")
    log = change_log(spark, d).withColumn("place", at)
    versions = log.filter(F.col("_op") == "I").groupBy(F.col("slot").alias("rel"), "place").agg(F.max("_seq").alias("version"))
    return replay.as_of(log.select("_seq", F.col("slot").alias("rel"), "place"), versions, "rel", "place", ["version"])
