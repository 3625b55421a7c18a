"""Casts, names, sizes and scalar functions (P rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import casts as C, names as N
from millrace.functions.transforms import partition_dir, partition_fields, with_partitions
from millrace.operators.envelope import op_code, to_events
from millrace.plans.fixtures import FEED, LOG, LOG_SPEC, change_log, raw_feed, table
from millrace.plans.registry import register
from millrace.session import work_dir
from millrace.spec import LAKE_TYPES, TYPE_NUMBERS, TableSpec, lake_type_column, type_name_column

# Column type of a cell, cycled over the events: every known name, upper case
# variants and some unknown ones.
_NAMES = [*LAKE_TYPES, "INTEGER", "Timestamptz", "interval", "int4[]", "tsrange"]

_SQL_TYPES = """types(src, lake) as (values
  ('smallint','int'), ('int2','int'), ('integer','int'), ('int','int'), ('int4','int'), ('serial','int'),
  ('bigint','long'), ('int8','long'), ('bigserial','long'), ('real','float'), ('float4','float'),
  ('double precision','double'), ('float8','double'), ('numeric','decimal(38,18)'), ('decimal','decimal(38,18)'),
  ('boolean','boolean'), ('bool','boolean'), ('text','string'), ('varchar','string'), ('character varying','string'),
  ('bpchar','string'), ('char','string'), ('character','string'), ('name','string'), ('bytea','binary'),
  ('date','date'), ('timestamp','timestamp'), ('timestamp without time zone','timestamp'),
  ('timestamptz','timestamptz'), ('timestamp with time zone','timestamptz'), ('uuid','uuid'),
  ('json','string'), ('jsonb','string'), ('INTEGER','int'), ('Timestamptz','timestamptz'),
  ('interval','string'), ('int4[]','string'), ('tsrange','string'))"""


@register("p1_type_map", f"""with {_SQL_TYPES},
n as (select src, lake, row_number() over () - 1 as i from types)
select n.src as source_type, n.lake as lake_type, count(*) as n
from events join n on n.i = event_id % (select count(*) from types) group by all""")
def p1(spark, d):
    names = F.array(*[F.lit(n) for n in _NAMES])
    cells = table(spark, d, "events").select(
        F.get(names, (F.col("event_id") % len(_NAMES)).cast("int")).alias("source_type"))
    return cells.withColumn("lake_type", lake_type_column(F.col("source_type"))).groupBy(
        "source_type", "lake_type").agg(F.count("*").alias("n"))


@register("p1_type_numbers", """
select cast(event_id % 4000 as integer) as number, case event_id % 4000
  when 16 then 'bool' when 17 then 'bytea' when 20 then 'int8' when 21 then 'int2' when 23 then 'int4'
  when 25 then 'text' when 114 then 'json' when 700 then 'float4' when 701 then 'float8' when 1042 then 'bpchar'
  when 1043 then 'varchar' when 1082 then 'date' when 1114 then 'timestamp' when 1184 then 'timestamptz'
  when 1700 then 'numeric' when 2950 then 'uuid' when 3802 then 'jsonb' else 'text' end as type, count(*) as n
from events group by all""")
def p1_numbers(spark, d):
    assert len(TYPE_NUMBERS) == 17
    number = (F.col("event_id") % 4000).cast("int")
    return table(spark, d, "events").select(number.alias("number")).withColumn(
        "type", type_name_column(F.col("number"))).groupBy("number", "type").agg(F.count("*").alias("n"))


TEXT_SPEC = TableSpec.of("public.cells", [
    ("event_id", "bigint"), ("small", "integer"), ("at", "timestamp"), ("on_day", "date"), ("flag", "boolean"),
    ("value", "double precision"), ("amount", "numeric(12,2)"), ("raw", "numeric"), ("props", "jsonb"),
], pk=["event_id"])


def _text_rows(spark, d):
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        (F.col("event_id") % 100).cast("string").alias("small"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00")).alias("at"),
        F.date_format("ts", "yyyy-MM-dd").alias("on_day"),
        F.when(F.col("event_id") % 2 == 0, "t").otherwise("f").alias("flag"),
        F.col("value").cast("string").alias("value"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("amount"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("raw"), "props")


TYPED = """select event_id, cast(event_id % 100 as integer) as small, ts as at, cast(ts as date) as on_day,
  event_id % 2 = 0 as flag, value, cast(value as decimal(12,2)) as amount,
  cast(cast(value as decimal(12,2)) as varchar) as raw, props from events"""


@register("p2_typed_rows", TYPED)
def p2(spark, d):
    return C.typed_rows(_text_rows(spark, d), TEXT_SPEC)


@register("p2_typed_rows_lenient", """select event_id,
  case when event_id % 10 = 0 then null else cast(event_id % 100 as integer) end as small,
  case when event_id % 10 = 0 then null else ts end as at from events""")
def p2_lenient(spark, d):
    bad = F.col("event_id").cast("bigint") % 10 == 0
    rows = _text_rows(spark, d).withColumns({
        "small": F.when(bad, "x1").otherwise(F.col("small")), "at": F.when(bad, "soon").otherwise(F.col("at"))})
    return C.typed_rows(rows, TEXT_SPEC, strict=False).select("event_id", "small", "at")


@register("p3_to_int_long", """select event_id,
  cast(trunc(case when event_id % 2 = 0 then value else -value end) as integer) as cut,
  cast(event_id % 1000 as integer) as small, event_id * 3000000000 as big from events""")
def p3(spark, d):
    e = table(spark, d, "events")
    signed = F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(-F.col("value"))
    return e.select(
        "event_id", C.to_int(signed).alias("cut"), C.to_int((F.col("event_id") % 1000).cast("string")).alias("small"),
        C.to_long((F.col("event_id") * 3000000000).cast("string")).alias("big"))


@register("p4_to_float_double", "select event_id, cast(value as float) as f, value as dbl from events")
def p4(spark, d):
    text = F.col("value").cast("string")
    return table(spark, d, "events").select("event_id", text.cast("float").alias("f"), text.cast("double").alias("dbl"))


@register("p5_to_bool", """select event_id, case event_id % 7 when 0 then true when 1 then true when 2 then true
  when 6 then null else false end as flag from events""")
def p5(spark, d):
    texts = F.array(*[F.lit(x) for x in ("t", "true", "1", "f", "yes", "TRUE")])
    text = F.get(texts, (F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", C.to_bool(text).alias("flag"))


@register("p6_to_timestamp", """select event_id, case event_id % 7
  when 0 then ts when 1 then ts - interval 330 minute when 2 then ts + interval 90 minute when 3 then ts
  when 4 then date_trunc('second', ts) when 5 then ts else date_trunc('second', ts) - interval 8 hour end as at
from events""")
def p6(spark, d):
    micros = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    whole = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    forms = F.array(
        F.concat(micros, F.lit("+00")), F.concat(micros, F.lit("+05:30")), F.concat(micros, F.lit("-0130")),
        F.concat(micros, F.lit("Z")), whole, F.concat(micros, F.lit("9+00:00")), F.concat(whole, F.lit("+08")))
    text = F.get(forms, (F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", C.to_ts(text).cast("timestamp_ntz").alias("at"))


@register("p7_to_date_days", """select o_orderkey, cast(o_orderdate as date) as day,
  cast(datediff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as days from orders""")
def p7(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, d, "orders").select(
        "o_orderkey", C.to_date(text).alias("day"), C.days_since_epoch(C.to_date(text)).alias("days"))


@register("p8_to_text", """select event_id, case when event_id % 2 = 0 then 't' else 'f' end as flag,
  cast(cast(value as decimal(12,2)) as varchar) as amount,
  regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0*$', '') || '+00' as at,
  strftime(ts, '%Y-%m-%d') as day, '\\x' || lower(hex(props)) as bytes, cast(event_id as varchar) as id from events""")
def p8(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id", C.to_text(F.col("event_id") % 2 == 0, "boolean").alias("flag"),
        C.to_text(F.col("value").cast("decimal(12,2)"), "numeric(12,2)").alias("amount"),
        C.to_text(F.col("ts").cast("timestamp"), "timestamptz").alias("at"),
        C.to_text(F.to_date("ts"), "date").alias("day"),
        C.to_text(F.col("props").cast("binary"), "bytea").alias("bytes"),
        C.to_text(F.col("event_id"), "bigint").alias("id"))


@register("p9_required_null_fill", f"""with {LOG}
select _seq, coalesce(value, 0.0) as value, coalesce(props, '') as props,
       case when _op = 'D' then timestamp '1970-01-01' else _ts end as at, coalesce(_op = nullif(_op, 'U'), false) as flag
from log""")
def p9(spark, d):
    spec = TableSpec.of("public.filled", [
        ("_seq", "bigint", False), ("value", "double precision", False), ("props", "text", False),
        ("at", "timestamp", False), ("flag", "boolean", False)], pk=["_seq"])
    rows = change_log(spark, d).select(
        "_seq", "value", "props", F.when(F.col("_op") != "D", F.col("_ts")).alias("at"),
        F.when(F.col("_op") != "U", True).alias("flag"))
    return C.fill_required(rows, spec)


@register("p10_op_codes", f"""with {FEED}
select op, _op as code, count(*) as n from dml group by all
union all select 'BEGIN', 'BEGIN', count(*) from tx
union all select 'COMMIT', 'COMMIT', count(*) from done""")
def p10(spark, d):
    return raw_feed(spark, d).groupBy("op", op_code(F.col("op")).alias("code")).agg(F.count("*").alias("n"))


@register("p11_event_envelope", f"""with {FEED}
select _op, lsn as _lsn, source_ts as _ts, pos as _seq, _unchanged_cols, user_id, slot, value, props from dml""")
def p11(spark, d):
    return to_events(raw_feed(spark, d), LOG_SPEC)


@register("p11_key_change", f"""with {FEED}
select _op, pos as _seq, _unchanged_cols, user_id, slot, value, props from dml
union all
select 'D', pos, null, user_id, cast(slot + 100 as integer), null, null from dml where _op = 'U' and pos % 9 = 0""")
def p11_key_change(spark, d):
    """Every ninth update arrives with another key in its before-image: a delete of it is added."""
    feed = raw_feed(spark, d)
    moved = (F.col("op") == "UPDATE") & (F.col("pos") % 9 == 0)
    old = F.struct(F.col("after.user_id").alias("user_id"), (F.col("after.slot") + 100).alias("slot"),
                   F.col("after.value").alias("value"), F.col("after.props").alias("props"))
    feed = feed.withColumn("before", F.when(moved, old).otherwise(F.col("before")))
    return to_events(feed, LOG_SPEC).select("_op", "_seq", "_unchanged_cols", *LOG_SPEC.columns)


@register("p12_unchanged_list", f"""with {LOG}
select _seq, _unchanged_cols as csv, cast(coalesce(len(string_split(_unchanged_cols, ',')), 0) as integer) as n,
       coalesce(list_contains(string_split(_unchanged_cols, ','), 'value'), false) as has_value
from log""")
def p12(spark, d):
    arr = N.unchanged_array(F.col("_unchanged_cols"))
    rows = change_log(spark, d).select("_seq", arr.alias("a"))
    return rows.select("_seq", N.unchanged_csv(F.col("a")).alias("csv"), F.size("a").alias("n"),
                       F.array_contains("a", "value").alias("has_value"))


NULL_KEYS = "select user_id as a, case when event_id % 5 <> 0 then cast(event_id % 7 as integer) end as b, event_id from events"


@register("p13_composite_key", f"""with k as ({NULL_KEYS})
select cast(a as varchar) || '|' || coalesce(cast(b as varchar), '') as key, b is null as open_key,
       min(event_id) as first, max(event_id) as last from k group by a, b""")
def p13(spark, d):
    """Keys with nulls group and join by value; the text form is for display only.

    Both join sides hold one row per key."""
    k = table(spark, d, "events").select(
        F.col("user_id").alias("a"), F.when(F.col("event_id") % 5 != 0, (F.col("event_id") % 7).cast("int")).alias("b"),
        "event_id")
    first = k.groupBy("a", "b").agg(F.min("event_id").alias("first"))
    last = k.groupBy("a", "b").agg(F.max("event_id").alias("last"))
    joined = first.alias("x").join(last.alias("y"), N.pk_equal("x", "y", ["a", "b"]))
    return joined.select("x.a", "x.b", "first", "last").select(
        N.pk_text(["a", "b"]).alias("key"), F.col("b").isNull().alias("open_key"), "first", "last")


NAMED = """named as (select event_id, case event_id % 4 when 0 then event_type when 1 then 'public.' || event_type
  when 2 then 'PUBLIC.' || event_type else 'app.' || event_type end as name from events)"""


@register("p14_table_names", f"""with {NAMED}
select event_id, case event_id % 4 when 3 then name else 'public.' || string_split(name, '.')[-1] end as full_name,
       string_split(name, '.')[-1] as lake_name from named""")
def p14(spark, d):
    m, t = F.col("event_id") % 4, F.col("event_type")
    name = F.when(m == 0, t).when(m == 1, F.concat(F.lit("public."), t)).when(
        m == 2, F.concat(F.lit("PUBLIC."), t)).otherwise(F.concat(F.lit("app."), t))
    return table(spark, d, "events").select(
        "event_id", N.qualified(name).alias("full_name"), N.lake_name(name).alias("lake_name"))


@register("p15_log_position", """select event_id, event_id * 123456789 + 17 as lsn,
  to_hex((event_id * 123456789 + 17) // 4294967296) || '/' || to_hex((event_id * 123456789 + 17) % 4294967296) as text,
  event_id * 1000 as lag from events""")
def p15(spark, d):
    pos = F.col("event_id") * 123456789 + 17
    rows = table(spark, d, "events").select(
        "event_id", C.lsn_text(pos).alias("text"), C.lsn_text(pos + F.col("event_id") * 1000).alias("ahead"))
    return rows.select("event_id", "text", C.lsn(F.col("text")).alias("lsn"),
                       C.lag_bytes(F.col("ahead"), F.col("text")).alias("lag"))


@register("p16_source_epoch", "select event_id, ts as at from events")
def p16(spark, d):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - 946684800000000
    return table(spark, d, "events").select(
        "event_id", C.from_source_epoch(micros).cast("timestamp_ntz").alias("at"))


@register("p17_row_bytes", f"""with {LOG}
select _op, sum(8 + 4 + case when value is null then 1 else 8 end
  + case when props is null then 1 else strlen(props) + 4 end)::bigint as bytes, count(*) as n from log group by _op""")
def p17(spark, d):
    size = C.row_bytes(LOG_SPEC.schema)
    return change_log(spark, d).groupBy("_op").agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))


@register("p18_text_number_scalars", """select doc_id, cast(length(text) as integer) as chars, substr(text, 1, 20) as head,
  round(n_chars / 7.0, 6) as seventh from documents""")
def p18(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.length("text").alias("chars"), F.substring("text", 1, 20).alias("head"),
        F.round(F.col("n_chars") / 7.0, 6).alias("seventh")).orderBy("doc_id")


@register("p19_partition_dir", """select 'o_orderstatus=' || o_orderstatus || '/o_orderdate_year=' || (year(o_orderdate) - 1970) as dir,
  count(*) as n from orders group by 1""")
def p19(spark, d):
    """Rows written by partition, their directory read back from the file path."""
    o = table(spark, d, "orders")
    fields = partition_fields(["o_orderstatus", "year(o_orderdate)"], TableSpec.from_df(o, "orders"))
    out = work_dir(spark, "p19") + "/data"
    with_partitions(o, fields).write.partitionBy(*[f.name for f in fields]).parquet(out)
    files = spark.read.parquet(out).select(F.col("_metadata.file_path").alias("f"))
    return files.groupBy(partition_dir(F.col("f")).alias("dir")).agg(F.count("*").alias("n"))
