"""Partition transforms (X rows)."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.functions import transforms as X
from millrace.plans.fixtures import table
from millrace.plans.registry import register
from millrace.spec import TableSpec

# -- SQL counterpart of Murmur3, in 64-bit arithmetic -------------------------

M32 = "4294967296"


def _mul(a: str, b: int) -> str:
    # Two 32-bit factors always fit an unsigned 64-bit product.
    return f"((({a})::ubigint * {b}::ubigint) % {M32}::ubigint)::bigint"


def _rot(a: str, r: int) -> str:
    return f"(((({a}) << {r}) | (({a}) >> {32 - r})) & 4294967295)"


def _k(block: str) -> str:
    return _mul(_rot(_mul(block, 0xCC9E2D51), 15), 0x1B873593)


def _round(h: str, block: str) -> str:
    return f"(({_mul(_rot(f'xor({h}, {_k(block)})', 13), 5)} + {0xE6546B64}) % {M32})"


def _fmix_steps(start: str) -> list[str]:
    """Finalizer as a chain of column definitions, each using the one before."""
    return [
        f"xor({start}, {start} >> 16)", _mul("h1", 0x85EBCA6B), "xor(h2, h2 >> 13)",
        _mul("h3", 0xC2B2AE35), "xor(h4, h4 >> 16)",
    ]


def murmur_ctes(source: str, blocks: str, n_bytes: str, tail: str | None = None, keep: str = "*") -> str:
    """CTEs ``hashed`` with column ``h`` from a list of 32-bit blocks and an optional tail."""
    state = f"list_reduce(list_prepend(0::bigint, {blocks}), lambda h, k: {_round('h', 'k')})"
    mixed = f"xor(({state}), {_k(tail)})" if tail else f"({state})"
    steps = _fmix_steps("h0")
    out = [f"m0 as (select {keep}, xor({mixed}, {n_bytes}) as h0 from {source})"]
    for i, step in enumerate(steps, start=1):
        out.append(f"m{i} as (select *, {step} as h{i} from m{i - 1})")
    out.append("hashed as (select *, h5 as h from m5)")
    return ",\n".join(out)


def hex_ctes(source: str, hex_col: str) -> str:
    """Murmur3 of bytes given as a hex text column."""
    block = "('0x' || substr(b, 7, 2) || substr(b, 5, 2) || substr(b, 3, 2) || substr(b, 1, 2))::bigint"
    n = f"(length({hex_col}) // 2)"
    start = f"8 * ({n} // 4)"
    tail = (f"('0x0' || substr({hex_col}, {start} + 5, 2) || substr({hex_col}, {start} + 3, 2) || "
            f"substr({hex_col}, {start} + 1, 2))::bigint")
    blocks = f"list_transform(regexp_extract_all({hex_col}, '.{{8}}'), lambda b: {block})"
    return murmur_ctes(source, blocks, n, tail)


def _long_blocks(value: str) -> str:
    low = f"((({value})::hugeint + 18446744073709551616) % 18446744073709551616)"
    return f"[({low} % {M32})::bigint, ({low} // {M32})::bigint]"


BUCKET = "cast((h & 2147483647) % {n} as integer)"


@register("x1_identity", "select o_orderpriority as o_orderpriority, count(*) as n from orders group by 1")
def x1(spark, d):
    spec = TableSpec.from_df(table(spark, d, "orders"), "orders", ["o_orderkey"])
    col, = X.partition_columns(["o_orderpriority"], spec)
    return table(spark, d, "orders").groupBy(col).agg(F.count("*").alias("n"))


def _time(name, kind, expr):
    @register(name, f"""select event_id, cast({expr} as integer) as ts_{kind}
from (select event_id, ts - to_days(cast(event_id % 400 * 60 as integer)) as ts from events)""")
    def run(spark, d):
        # Shifted back up to 65 years, so many values lie before 1970.
        e = table(spark, d, "events").select(
            "event_id", (F.col("ts") - F.make_dt_interval(days=(F.col("event_id") % 400 * 60).cast("int"))).alias("ts"))
        spec = TableSpec.from_df(e, "events", ["event_id"])
        return e.select("event_id", *X.partition_columns([f"{kind}(ts)"], spec))


_time("x2_year", "year", "year(ts) - 1970")
_time("x3_month", "month", "(year(ts) - 1970) * 12 + month(ts) - 1")
_time("x4_day", "day", "datediff('day', date '1970-01-01', cast(ts as date))")
_time("x5_hour", "hour", "floor(epoch_us(ts) / 3600000000.0)")


@register("x6_bucket_int", f"""with src as (select p_partkey, p_size from part),
{murmur_ctes('src', '[((p_size + 4294967296) % 4294967296)::bigint]', '4')}
select p_partkey, {BUCKET.format(n=16)} as p_size_bucket from hashed""")
def x6(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", *X.partition_columns(["bucket[16](p_size)"], TableSpec.from_df(p, "part")))


@register("x6_bucket_int_standard", f"""with src as (select p_partkey, p_size from part),
{murmur_ctes('src', _long_blocks('p_size'), '8')}
select p_partkey, {BUCKET.format(n=16)} as b from hashed""")
def x6_standard(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.bucket(16, F.col("p_size"), T.IntegerType(), spec=True).alias("b"))


@register("x7_bucket_bigint", f"""with src as (select o_orderkey, o_orderkey * 987654321 - 5000000000000 as k from orders),
{murmur_ctes('src', _long_blocks('k'), '8')}
select o_orderkey, {BUCKET.format(n=32)} as k_bucket from hashed""")
def x7(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 987654321 - 5000000000000).alias("k"))
    return o.select("o_orderkey", *X.partition_columns(["bucket[32](k)"], TableSpec.from_df(o, "o")))


@register("x7_bucket_timestamp", f"""with src as (select event_id, epoch_us(ts) as us from events),
{murmur_ctes('src', _long_blocks('us'), '8')}
select event_id, {BUCKET.format(n=32)} as ts_bucket from hashed""")
def x7_ts(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", *X.partition_columns(["bucket[32](ts)"], TableSpec.from_df(e, "e")))


@register("x7_bucket_date", f"""with src as (
  select o_orderkey, datediff('day', date '1970-01-01', cast(o_orderdate as date)) as dd from orders),
{murmur_ctes('src', '[((dd + 4294967296) % 4294967296)::bigint]', '4')}
select o_orderkey, {BUCKET.format(n=8)} as o_date_bucket from hashed""")
def x7_date(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_date"))
    return o.select("o_orderkey", *X.partition_columns(["bucket[8](o_date)"], TableSpec.from_df(o, "o")))


@register("x8_bucket_text", f"""with src as (select doc_id, hex(text) as hx from documents),
{hex_ctes('src', 'hx')}
select doc_id, {BUCKET.format(n=64)} as text_bucket from hashed""")
def x8(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    return t.select("doc_id", *X.partition_columns(["bucket[64](text)"], TableSpec.from_df(t, "documents")))


@register("x8_bucket_binary", f"""with src as (select event_id, lower(hex(props)) as hx from events),
{hex_ctes('src', 'hx')}
select event_id, {BUCKET.format(n=64)} as b_bucket from hashed""")
def x8_binary(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("props").cast("binary").alias("b"))
    return e.select("event_id", *X.partition_columns(["bucket[64](b)"], TableSpec.from_df(e, "e")))


SIGNED_PRICE = ("cast(case when o_orderkey % 3 = 0 then -cast(o_totalprice as decimal(12,2)) "
                "else cast(o_totalprice as decimal(12,2)) end as decimal(12,2))")


def _priced(spark, d):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, -price).otherwise(price).cast("decimal(12,2)").alias("price"))


DEC_HEX = f"""raw as (select o_orderkey, to_hex(cast(abs({SIGNED_PRICE}) * 100 as bigint)) as x from orders),
src as (select o_orderkey, case when x = '0' then '' when length(x) % 2 = 1 then '0' || x else x end as hx from raw)"""


@register("x9_bucket_decimal", f"""with {DEC_HEX},
{hex_ctes('src', 'hx')}
select o_orderkey, {BUCKET.format(n=64)} as price_bucket from hashed""")
def x9(spark, d):
    o = _priced(spark, d)
    return o.select("o_orderkey", *X.partition_columns(["bucket[64](price)"], TableSpec.from_df(o, "o")))


@register("x9_bucket_wide_decimal", f"""with {DEC_HEX},
{hex_ctes('src', 'hx')}
select o_orderkey, {BUCKET.format(n=64)} as price_bucket from hashed""")
def x9_wide(spark, d):
    """The same values in a 38-digit decimal take the long-hand path and must agree."""
    o = _priced(spark, d).withColumn("price", F.col("price").cast("decimal(38,2)"))
    return o.select("o_orderkey", *X.partition_columns(["bucket[64](price)"], TableSpec.from_df(o, "o")))


@register("x10_truncate_int", """
select p_partkey, cast(v - ((v % 7) + 7) % 7 as integer) as v_truncate
from (select p_partkey, case when p_partkey % 2 = 0 then -p_size else p_size end as v from part)""")
def x10(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 2 == 0, -F.col("p_size")).otherwise(F.col("p_size")).alias("v"))
    return p.select("p_partkey", *X.partition_columns(["truncate[7](v)"], TableSpec.from_df(p, "p")))


@register("x10_truncate_bigint", """
select event_id, v - ((v % 100) + 100) % 100 as v_truncate
from (select event_id, user_id * 1000003 - event_id * 7919 as v from events)""")
def x10_long(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("user_id") * 1000003 - F.col("event_id") * 7919).alias("v"))
    return e.select("event_id", *X.partition_columns(["truncate[100](v)"], TableSpec.from_df(e, "e")))


@register("x11_truncate_text", "select doc_id, substr(text, 1, 12) as text_truncate from documents")
def x11(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    return t.select("doc_id", *X.partition_columns(["truncate[12](text)"], TableSpec.from_df(t, "t")))


@register("x12_truncate_decimal", f"""
select o_orderkey, cast((u - ((u % 50) + 50) % 50) / 100.0 as decimal(13,2)) as price_truncate
from (select o_orderkey, cast({SIGNED_PRICE} * 100 as bigint) as u from orders)""")
def x12(spark, d):
    o = _priced(spark, d)
    return o.select("o_orderkey", *X.partition_columns(["truncate[50](price)"], TableSpec.from_df(o, "o")))


@register("x13_truncate_binary", """
select doc_id, replace(replace(replace(to_base64(encode(substr(text, 1, 1)) || from_hex('fb') || encode(substr(text, 2, 1))),
  '/', '%2F'), '+', '%2B'), '=', '%3D') as b_truncate
from (select doc_id, regexp_replace(text, '[^a-z]', '', 'g') || 'xy' as text from documents)""")
def x13(spark, d):
    letters = F.concat(F.regexp_replace("text", "[^a-z]", ""), F.lit("xy"))
    t = table(spark, d, "documents").select("doc_id", letters.alias("l")).select(
        "doc_id", F.concat(F.substring("l", 1, 1).cast("binary"), F.unhex(F.lit("FB")),
                           F.expr("substring(l, 2)").cast("binary")).alias("b"))
    return t.select("doc_id", *X.partition_columns(["truncate[3](b)"], TableSpec.from_df(t, "t")))


MULTI = ["o_orderstatus", "year(o_orderdate)", "bucket[8](o_custkey)", "truncate[1000](o_orderkey)"]


@register("x14_validated_spec", f"""with src as (select * from orders),
{murmur_ctes('src', _long_blocks('o_custkey'), '8')}
select o_orderstatus, cast(year(o_orderdate) - 1970 as integer) as o_orderdate_year,
       {BUCKET.format(n=8)} as o_custkey_bucket, o_orderkey - o_orderkey % 1000 as o_orderkey_truncate, count(*) as n
from hashed group by all""")
def x14(spark, d):
    """A spec that passes validation, applied; specs that must fail are refused first."""
    o = table(spark, d, "orders")
    spec = TableSpec.from_df(o, "orders", ["o_orderkey"])
    for bad in ("day(o_orderkey)", "bucket[0](o_custkey)", "bucket[4](o_totalprice)", "truncate(o_orderkey)",
                "truncate[3](o_orderdate)", "week(o_orderdate)", "day(nope)"):
        try:
            X.partition_fields([bad], spec)
        except ValueError:
            continue
        raise AssertionError(f"{bad} must be refused")
    return o.groupBy(*X.partition_columns(MULTI, spec)).agg(F.count("*").alias("n"))


def _path_source(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("prio"), "o_orderdate")
    fields = X.partition_fields(["prio", "month(o_orderdate)", "truncate[500](o_orderkey)"], TableSpec.from_df(o, "o"))
    return X.with_partitions(o, fields), fields


PATHS = """src as (
  select o_orderkey, case when o_orderkey % 6 <> 0 then o_orderpriority end as prio,
         cast((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 as integer) as m,
         o_orderkey - o_orderkey % 500 as t from orders)"""


@register("x15_partition_path", f"""with {PATHS}
select o_orderkey, 'prio=' || coalesce(prio, '__null__') || '/o_orderdate_month=' || m ||
       '/o_orderkey_truncate=' || t as path from src""")
def x15(spark, d):
    rows, fields = _path_source(spark, d)
    return rows.select("o_orderkey", X.partition_path(fields).alias("path"))


@register("x16_parse_partition_path", f"""with {PATHS}
select o_orderkey, prio, m as o_orderdate_month, t as o_orderkey_truncate from src""")
def x16(spark, d):
    rows, fields = _path_source(spark, d)
    paths = rows.select("o_orderkey", X.partition_path(fields).alias("path"))
    return paths.select("o_orderkey", X.parse_partition_path(F.col("path"), fields).alias("v")).select("o_orderkey", "v.*")


@register("x17_rows_per_partition", """
select cast(datediff('day', date '1970-01-01', cast(l_shipdate as date)) as integer) as l_shipdate_day, count(*) as n
from lineitem group by 1""")
def x17(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy(*X.partition_columns(["day(l_shipdate)"], TableSpec.from_df(li, "l"))).agg(F.count("*").alias("n"))


@register("x18_result_types", """
select t.kind, t.type, count(*) as n from orders, (values ('o_orderdate_day', 'int'), ('o_custkey_bucket', 'int'),
  ('o_orderkey_truncate', 'bigint'), ('o_orderpriority_truncate', 'string'), ('price_truncate', 'decimal(13,2)'),
  ('b_truncate', 'string')) t(kind, type)
where o_totalprice is not null group by all""")
def x18(spark, d):
    """Declared result types against the types Spark gives each value."""
    o = table(spark, d, "orders").withColumns({
        "price": F.col("o_totalprice").cast("decimal(12,2)"), "b": F.col("o_orderstatus").cast("binary")})
    fields = X.partition_fields(
        ["day(o_orderdate)", "bucket[4](o_custkey)", "truncate[10](o_orderkey)", "truncate[2](o_orderpriority)",
         "truncate[50](price)", "truncate[1](b)"], TableSpec.from_df(o, "o"))
    for f in fields:
        if o.select(f.column()).schema[0].dataType != f.result_type:
            raise AssertionError(f"{f.name}: {o.select(f.column()).schema[0].dataType} is not {f.result_type}")
    types = F.array(*[F.struct(F.lit(f.name).alias("kind"), F.typeof(f.column()).alias("type")) for f in fields])
    return o.select(F.inline(types)).groupBy("kind", "type").agg(F.count("*").alias("n"))
