"""Change feeds derived from the given tables, as DataFrames and as SQL.

Every definition exists twice on purpose: once in DataFrame form for the
engine and once in SQL for the independent check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.spec import TableSpec


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- change log over events ---------------------------------------------------
# Key (user_id, slot); order event_id. signup inserts, error deletes, the rest
# update: 'view' leaves out props, 'click' leaves out value and props.

LOG_SPEC = TableSpec.of(
    "public.activity",
    [("user_id", "bigint", False), ("slot", "integer", False), ("value", "double precision"), ("props", "text")],
    pk=["user_id", "slot"],
)


def change_log(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    kind = F.col("event_type")
    return e.select(
        "user_id", (F.col("event_id") % 7).cast("int").alias("slot"),
        F.col("event_id").alias("_seq"), F.floor(F.col("event_id") / 4).alias("_xid"),
        (F.col("event_id") * 10).alias("_lsn"), F.col("ts").alias("_ts"),
        F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("_op"),
        F.when(kind == "view", "props").when(kind == "click", "value,props").alias("_unchanged_cols"),
        F.when(~kind.isin("click", "error"), F.col("value")).alias("value"),
        F.when(~kind.isin("view", "click", "error"), F.col("props")).alias("props"),
    )


LOG = """log as (
  select user_id, cast(event_id % 7 as integer) as slot, event_id as _seq, event_id // 4 as _xid,
         event_id * 10 as _lsn, ts as _ts,
         case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as _op,
         case event_type when 'view' then 'props' when 'click' then 'value,props' end as _unchanged_cols,
         case when event_type in ('click', 'error') then null else value end as value,
         case when event_type in ('view', 'click', 'error') then null else props end as props
  from events)"""


def fold_sql(name: str, source: str, by: str = "", where: str = "true", order: str = "_seq") -> str:
    """SQL fold of a change log: last op, last known values, known flags."""
    known = {
        c: f"(_op <> 'U' or not list_contains(string_split(coalesce(_unchanged_cols, ''), ','), '{c}'))"
        for c in ("value", "props")
    }
    keys = f"{by}user_id, slot"
    cols = ", ".join(
        f"arg_max_null({c}, {order}) filter (where {k}) as {c}, "
        f"count(*) filter (where {k}) > 0 as known_{c}" for c, k in known.items()
    )
    return (
        f"{name} as (select {keys}, arg_max(_op, {order}) as op, max({order}) as seq, {cols} "
        f"from {source} where {where} group by {keys})"
    )


HALF = "(select (max(event_id) + 1) // 2 from events)"


def half(spark: SparkSession, d: str):
    """Sequence that splits the log into base and batch."""
    return table(spark, d, "events").agg(F.floor((F.max("event_id") + 1) / 2).alias("h")).scalar()


def base_and_batch(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Table after the first half of the log, and the events of the second half."""
    from millrace.operators.fold import fold, live

    log, edge = change_log(spark, d), half(spark, d)
    base = live(fold(log.filter(F.col("_seq") < edge), LOG_SPEC), LOG_SPEC)
    return base, log.filter(F.col("_seq") >= edge)


BASE_BATCH = ",\n".join([
    LOG,
    fold_sql("base_f", "log", where=f"_seq < {HALF}"),
    "base as (select user_id, slot, value, props from base_f where op <> 'D')",
    fold_sql("batch", "log", where=f"_seq >= {HALF}"),
])

STATE = ",\n".join([
    LOG, fold_sql("state_f", "log"),
    "state as (select user_id, slot, value, props from state_f where op <> 'D')",
])

# -- the log cut into numbered commits ---------------------------------------

# A fixed number of commits whatever the size of the log, as between two compactions.

COMMIT_COUNT = 40


def commit_log(spark: SparkSession, d: str) -> DataFrame:
    total = table(spark, d, "events").agg(F.max("event_id") + 1).scalar()
    return change_log(spark, d).withColumn("_commit", F.floor(F.col("_seq") * COMMIT_COUNT / total))


COMMITS = f"""{LOG},
clog as (select *, _seq * {COMMIT_COUNT} // (select max(event_id) + 1 from events) as _commit from log)"""


# -- raw feed with transactions ----------------------------------------------
# Four events per transaction; the first four stand outside any (xid 0). Every
# tenth transaction never commits. Commits interleave: commit order differs
# from start order.

FEED_TABLE = "public.activity"


def raw_feed(spark: SparkSession, d: str) -> DataFrame:
    """DML and control rows of one table with typed row images."""
    e = change_log(spark, d).withColumn("event_id", F.col("_seq"))
    op = F.when(F.col("_op") == "I", "INSERT").when(F.col("_op") == "D", "DELETE").otherwise("UPDATE")
    image = F.struct(*LOG_SPEC.columns)
    dml = e.select(
        F.lit(FEED_TABLE).alias("table"), op.alias("op"), F.col("_xid").alias("xid"),
        F.col("_lsn").alias("lsn"), F.col("_seq").alias("pos"), F.col("_ts").alias("source_ts"),
        (F.col("_ts") + F.make_dt_interval(secs=F.col("_seq") % 90)).alias("proc_ts"),
        F.when(F.col("_op") == "D", image).alias("before"),
        F.when(F.col("_op") != "D", image).alias("after"),
        F.when(F.col("_unchanged_cols").isNotNull(), F.split("_unchanged_cols", ",")).alias("unchanged_cols"),
    )
    tx = e.filter(F.col("_xid") != 0).groupBy(F.col("_xid").alias("xid")).agg(
        F.min("_ts").alias("first_ts"), F.max("_ts").alias("last_ts"))
    nulls = [F.lit(None).cast(dml.schema[c].dataType).alias(c) for c in ("before", "after", "unchanged_cols")]
    second = F.make_dt_interval(secs=F.lit(1))

    def control(name, rows, lsn, ts):
        return rows.select(
            F.lit(None).cast("string").alias("table"), F.lit(name).alias("op"), "xid", lsn.alias("lsn"),
            lsn.alias("pos"), ts.alias("source_ts"), ts.alias("proc_ts"), *nulls)

    begin = control("BEGIN", tx, F.col("xid") * 40 - 5, F.col("first_ts") - second)
    commit = control("COMMIT", tx.filter(F.col("xid") % 10 != 0),
                     F.col("xid") * 40 + 35 + (F.col("xid") % 3) * 100, F.col("last_ts") + second)
    return dml.unionByName(begin).unionByName(commit)


FEED = f"""{LOG},
dml as (
  select '{FEED_TABLE}' as "table",
         case _op when 'I' then 'INSERT' when 'D' then 'DELETE' else 'UPDATE' end as op,
         _xid as xid, _lsn as lsn, _seq as pos, _ts as source_ts,
         _ts + to_seconds(_seq % 90) as proc_ts, user_id, slot, value, props, _op, _unchanged_cols
  from log),
tx as (
  select _xid as xid, min(_ts) - interval 1 second as begin_ts, max(_ts) + interval 1 second as commit_ts,
         _xid * 40 - 5 as begin_lsn, _xid * 40 + 35 + (_xid % 3) * 100 as commit_lsn
  from log where _xid <> 0 group by _xid),
done as (select * from tx where xid % 10 <> 0)"""

# Committed rows with their replay order; rows outside transactions stand at their own position.
COMMITTED = f"""{FEED},
committed as (
  select dml.*, done.commit_lsn, done.commit_ts from dml join done using (xid) where dml.xid <> 0
  union all
  select dml.*, dml.lsn as commit_lsn, dml.source_ts as commit_ts from dml where dml.xid = 0)"""


# -- several tables in one feed ----------------------------------------------
# One transaction per order: the order row and its line items.


def shop_feed(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    orders = o.select(
        F.lit("public.orders").alias("table"),
        F.when(F.col("o_orderstatus") == "F", "UPDATE").otherwise("INSERT").alias("op"),
        F.col("o_orderkey").alias("xid"), (F.col("o_orderkey") * 100).alias("lsn"),
        F.col("o_orderdate").alias("source_ts"),
    )
    lines = li.select(
        F.lit("public.lineitem").alias("table"),
        F.when(F.col("l_returnflag") == "R", "DELETE").otherwise("INSERT").alias("op"),
        F.col("l_orderkey").alias("xid"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("lsn"),
        F.col("l_shipdate").alias("source_ts"),
    )
    return orders.unionByName(lines)


SHOP = """shop as (
  select 'public.orders' as "table", case when o_orderstatus = 'F' then 'UPDATE' else 'INSERT' end as op,
         o_orderkey as xid, o_orderkey * 100 as lsn, o_orderdate as source_ts from orders
  union all
  select 'public.lineitem', case when l_returnflag = 'R' then 'DELETE' else 'INSERT' end,
         l_orderkey, l_orderkey * 100 + l_linenumber, l_shipdate from lineitem)"""


# -- the raw feed as files: row images as text, dropped in log order ----------


def text_feed(spark: SparkSession, d: str) -> DataFrame:
    from millrace.functions.casts import to_text
    from millrace.sources.feed import FEED_SCHEMA

    feed = raw_feed(spark, d)

    def texts(side):
        pairs = [x for c in LOG_SPEC.columns
                 for x in (F.lit(c), to_text(F.col(f"{side}.{c}"), LOG_SPEC.source_type(c)))]
        return F.when(F.col(side).isNotNull(), F.create_map(*pairs))

    return feed.withColumns({
        "before": texts("before"), "after": texts("after"),
        "source_ts": F.col("source_ts").cast("timestamp"), "proc_ts": F.col("proc_ts").cast("timestamp"),
    }).select(*FEED_SCHEMA.names)


def drops(feed: DataFrame, n: int = 3) -> list[DataFrame]:
    """The feed cut into ``n`` stretches of the log. Transactions span the cuts."""
    top = feed.agg(F.max("lsn") + 1).scalar()
    cut = F.floor(F.col("lsn") * n / top)
    return [feed.filter(F.greatest(cut, F.lit(0)) == i) for i in range(n)]
