"""Schema evolution (E rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evolve as ev
from millrace.operators.fold import fold, live
from millrace.plans.fixtures import HALF, LOG, LOG_SPEC, change_log, drops, fold_sql, half, table, text_feed
from millrace.plans.registry import register
from millrace.plans.transactions import REPLAY
from millrace.session import work_dir
from millrace.sinks import schemas, tables as table_sink
from millrace.sources.feed import FEED_SCHEMA, read_feed_batch
from millrace.spec import SchemaChange, TableSpec
from millrace.streaming.pipeline import feed_batch, materialize


# -- column catalogs as data: one small table per user, its columns from its events


OLD = """old_c as (select user_id, event_type as "column", case when event_id % 2 = 0 then 'int4' else 'text' end as type
  from events where ts < timestamp '2024-01-10' qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1)"""
NEW = """new_c as (select user_id, event_type as "column", case when event_id % 2 = 0 then 'int4' else 'int8' end as type
  from events where event_id % 3 <> 0 and ts >= timestamp '2024-01-20' qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1)"""
CATALOG_DIFF = f"""{OLD}, {NEW},
diff as (select user_id, "column", o.type as old_type, n.type as new_type,
  case when o.type is null then 'added' when n.type is null then 'dropped' else 'retyped' end as change
  from old_c o full outer join new_c n using (user_id, "column") where o.type is distinct from n.type)"""


def _catalogs(spark, d):
    from millrace.operators.latest import latest_per_key

    e = table(spark, d, "events")
    keys = ["user_id", "column"]

    def cat(rows, odd):
        rows = rows.select("user_id", F.col("event_type").alias("column"), "event_id",
                           F.when(F.col("event_id") % 2 == 0, "int4").otherwise(odd).alias("type"))
        return latest_per_key(rows, keys, "event_id").select(*keys, "type")

    old = cat(e.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")), "text")
    new = cat(e.filter((F.col("event_id") % 3 != 0) & (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))), "int8")
    return old, new


@register("e1_schema_diff", f"with {CATALOG_DIFF}\nselect * from diff")
def e1(spark, d):
    return ev.catalog_diff(*_catalogs(spark, d), by=["user_id"])


@register("e10_apply_schema_changes", f"with {CATALOG_DIFF}\nselect * from new_c")
def e10(spark, d):
    """Old catalog plus its difference to the new one is the new one."""
    old, new = _catalogs(spark, d)
    return ev.apply_changes(old, ev.catalog_diff(old, new, by=["user_id"]), by=["user_id"])


# -- files of two versions read under one schema -----------------------------

V1 = TableSpec.of("public.orders", [
    ("o_orderkey", "bigint", False), ("o_custkey", "integer"), ("price", "real"), ("note", "text")], pk=["o_orderkey"])


def _v1_rows(spark, d):
    o = table(spark, d, "orders").filter(F.col("o_orderkey") % 2 == 0)
    return o.select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"),
                    (F.floor(F.col("o_totalprice") / 1000) / 4).cast("float").alias("price"),
                    F.col("o_orderstatus").alias("note"))


def _v2_rows(spark, d, spec):
    o = table(spark, d, "orders").filter(F.col("o_orderkey") % 2 == 1)
    made = {
        "o_orderkey": F.col("o_orderkey"), "o_custkey": F.col("o_custkey") + 3000000000, "price": F.col("o_totalprice"),
        "note": F.col("o_orderstatus"), "prio": F.col("o_orderpriority"), "label": F.col("o_orderstatus"),
        "score": F.col("o_custkey"),
    }
    return o.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in spec.schema])


def _evolved(spark, d, spec, name):
    """Even keys written under the first schema, odd keys under ``spec``, read together."""
    out = work_dir(spark, name)
    ev.stamp_ids(_v1_rows(spark, d), V1).write.parquet(out + "/v1")
    ev.stamp_ids(_v2_rows(spark, d, spec), spec).write.parquet(out + "/v2")
    return ev.read_evolved(spark, [out + "/v1", out + "/v2"], spec)


OLD_PRICE = "cast(floor(o_totalprice / 1000) / 4 as float)"


def _case(even: str, odd: str, name: str) -> str:
    return f"case when o_orderkey % 2 = 0 then {even} else {odd} end as {name}"


@register("e2_add_column", f"""select o_orderkey, cast(case when o_orderkey % 2 = 0 then o_custkey else o_custkey end as integer) as o_custkey,
  {_case(OLD_PRICE, 'cast(o_totalprice as float)', 'price')}, o_orderstatus as note, {_case('null', 'o_orderpriority', 'prio')} from orders""")
def e2(spark, d):
    spec = V1.evolve(SchemaChange(added=(("prio", "text"),)))
    out = work_dir(spark, "e2")
    ev.stamp_ids(_v1_rows(spark, d), V1).write.parquet(out + "/v1")
    new = _v2_rows(spark, d, spec.evolve(SchemaChange(retyped=(("o_custkey", "bigint"),)))).withColumn(
        "o_custkey", F.col("o_custkey") - 3000000000)
    ev.stamp_ids(new, spec).write.parquet(out + "/v2")
    return ev.read_evolved(spark, [out + "/v1", out + "/v2"], spec)


WIDE = (("o_custkey", "bigint"), ("price", "double precision"))


@register("e3_drop_column", f"""select o_orderkey, {_case('o_custkey', 'o_custkey + 3000000000', 'o_custkey')},
  {_case(f'cast({OLD_PRICE} as double)', 'o_totalprice', 'price')} from orders""")
def e3(spark, d):
    return _evolved(spark, d, V1.evolve(SchemaChange(dropped=("note",), retyped=WIDE)), "e3")


@register("e4_rename_column", f"""select o_orderkey, {_case('o_custkey', 'o_custkey + 3000000000', 'o_custkey')},
  {_case(f'cast({OLD_PRICE} as double)', 'o_totalprice', 'price')}, {_case('null', 'o_orderstatus', 'label')} from orders""")
def e4(spark, d):
    return _evolved(spark, d, V1.evolve(SchemaChange(retyped=WIDE)).rename("note", "label"), "e4")


@register("e5_widen_columns", f"""select o_orderkey, {_case('o_custkey', 'o_custkey + 3000000000', 'o_custkey')},
  {_case(f'cast({OLD_PRICE} as double)', 'o_totalprice', 'price')}, o_orderstatus as note from orders""")
def e5(spark, d):
    return _evolved(spark, d, V1.evolve(SchemaChange(retyped=WIDE)), "e5")


@register("e6_noop_change", f"""select o_orderkey, {_case('o_custkey', 'o_custkey + 3000000000', 'o_custkey')},
  {_case(f'cast({OLD_PRICE} as double)', 'o_totalprice', 'price')}, o_orderstatus as note from orders""")
def e6(spark, d):
    """Text to varchar changes the declared type only."""
    wide = V1.evolve(SchemaChange(retyped=WIDE))
    change = SchemaChange(retyped=(("note", "varchar"),))
    after = wide.evolve(change)
    if not wide.is_noop(change) or [f.dataType for f in after.schema] != [f.dataType for f in wide.schema]:
        raise AssertionError("text to varchar must not change the stored schema")
    return _evolved(spark, d, after, "e6")


@register("e7_successive_changes", f"""select o_orderkey, {_case('o_custkey', 'o_custkey + 3000000000', 'o_custkey')},
  {_case(f'cast({OLD_PRICE} as double)', 'o_totalprice', 'price')}, {_case('null', 'o_orderpriority', 'prio')},
  {_case('null', 'o_custkey', 'score')} from orders""")
def e7(spark, d):
    spec = V1
    for change in (SchemaChange(added=(("prio", "text"),), dropped=("note",)),
                   SchemaChange(retyped=WIDE), SchemaChange(added=(("score", "bigint"),))):
        spec = spec.evolve(change)
    return _evolved(spark, d, spec, "e7")


@register("e8_schema_barrier", f"""with {LOG},
{fold_sql('f', 'log')}
select f.user_id, f.slot, f.value, f.props,
  case when last.n > 0 then last.sq end as score
from f left join (select user_id, slot, max(_seq) as sq, count(*) as n, arg_max(_op, _seq) as op from log
  where _seq >= {HALF} group by 1, 2) last on last.user_id = f.user_id and last.slot = f.slot
where f.op <> 'D'""")
def e8(spark, d):
    """A column appears half way: events before it have the old schema, later ones carry it."""
    log = change_log(spark, d)
    new_spec = LOG_SPEC.evolve(SchemaChange(added=(("score", "bigint"),)))
    old, new = ev.split_at(log, half(spark, d), "_seq")
    from millrace.operators.apply import apply

    base = ev.conform(live(fold(old, LOG_SPEC), LOG_SPEC), new_spec)
    later = fold(new.withColumn("score", F.col("_seq")), new_spec)
    return apply(base, later, new_spec)


@register("e9_events_schema_follows", f"""with {LOG}
select _op, _seq, user_id, slot, value, props, case when _seq % 2 = 1 then _seq * 2 end as score from log""")
def e9(spark, d):
    """Events written before and after a change, read under the events schema of the new spec."""
    new_spec = LOG_SPEC.evolve(SchemaChange(added=(("score", "bigint"),)))
    out = work_dir(spark, "e9")
    rows = change_log(spark, d).withColumn("score", F.col("_seq") * 2)
    for spec, part in ((LOG_SPEC, 0), (new_spec, 1)):
        es = TableSpec(spec.events_name, spec.events_schema())
        ev.stamp_ids(rows.filter(F.col("_seq") % 2 == part).select(*es.columns), es).write.parquet(f"{out}/{part}")
    es = TableSpec(new_spec.events_name, new_spec.events_schema())
    return ev.read_evolved(spark, [f"{out}/0", f"{out}/1"], es).select("_op", "_seq", *new_spec.columns)


@register("e8_change_inside_stream", f"""with {REPLAY},
last as (select user_id, slot, arg_max(lsn, ord) as lsn, arg_max(pos, ord) as pos from r group by 1, 2)
select f.user_id, f.slot, f.value, f.props, case when last.lsn >= {HALF} * 10 then last.pos end as score
from f join last on last.user_id = f.user_id and last.slot = f.slot where f.op <> 'D'""")
def e8_stream(spark, d):
    """The change is a row of the feed, between rows of open transactions; the whole pipeline follows it."""
    root = work_dir(spark, "e8")
    feed, edge = text_feed(spark, d), half(spark, d) * 10
    wide = F.map_concat("after", F.create_map(F.lit("score"), F.col("pos").cast("string")))
    rows = feed.withColumn("after", F.when(F.col("after").isNotNull() & (F.col("lsn") >= edge), wide).otherwise(F.col("after")))
    change = SchemaChange(added=(("score", "bigint"),)).to_map()
    at = table(spark, d, "events").agg((F.floor((F.max("event_id") + 1) / 2) * 10).alias("lsn"))
    marker = at.select(
        F.lit(LOG_SPEC.name).alias("table"), F.lit("SCHEMA_CHANGE").alias("op"), F.lit(0).cast("bigint").alias("xid"), "lsn",
        F.create_map(*[F.lit(x) for kv in change.items() for x in kv]).alias("after"))
    whole = rows.unionByName(marker, allowMissingColumns=True).select(*FEED_SCHEMA.names)
    for i, part in enumerate(drops(whole, 2)):
        part.write.parquet(f"{root}/in/{i}")
        feed_batch(read_feed_batch(spark, f"{root}/in/{i}"), i, [LOG_SPEC], f"{root}/events")
        materialize(spark, [LOG_SPEC], f"{root}/events", f"{root}/tables")
    now, = schemas.latest(spark, f"{root}/events", [LOG_SPEC])
    return table_sink.read_state(spark, f"{root}/tables", now)
