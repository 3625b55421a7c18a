"""Shape of the physical plans: what must hold when the data is large and skewed."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import transactions as tx
from millrace.operators.apply import apply, resolve_parts
from millrace.operators.envelope import known_relations
from millrace.operators.fold import fold
from millrace.operators.spread import spread_join
from millrace.operators.verify import diff_sample
from millrace.plans import load_all
from millrace.plans.fixtures import LOG_SPEC, change_log, table
from millrace.session import work_dir
from millrace.sinks import tables

pytestmark = pytest.mark.default_conf

# Queries that run jobs while they are built; their operators are covered by the others.
RUNS_JOBS = ("w", "k", "m9", "t8", "s4", "s10", "p19", "e2", "e3", "e4", "e5", "e6", "e7", "e8", "e9", "x14", "x18")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    old = {}

    def put(**kv):
        for k, v in kv.items():
            k = k.replace("__", ".")
            old[k] = spark.conf.get(k, None)
            spark.conf.set(k, v)

    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_all_pairs_and_no_python(spark, sf, conf):
    """With nothing small enough to broadcast, no query falls back to a product or to Python workers."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name, (fn, _) in load_all().items():
        if name.split("_")[0] in RUNS_JOBS or name[0] in ("w", "k"):
            continue
        text = plan(fn(spark, sf))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_fold_is_one_shuffle_with_partial_aggregation(spark, sf):
    text = plan(fold(change_log(spark, sf), LOG_SPEC))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text and "Window" not in text


def test_apply_reuses_the_partitioning_of_the_fold(spark, sf, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    base = table(spark, sf, "events").select(
        "user_id", (F.col("event_id") % 7).cast("int").alias("slot"), "value", "props")
    text = plan(apply(base, fold(change_log(spark, sf), LOG_SPEC), LOG_SPEC))
    # One for the events, one for the table, none in between.
    assert text.count("Exchange hashpartitioning") == 2


def test_narrow_apply_does_not_shuffle_the_table(spark, sf):
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("user_id"), F.lit(1).alias("slot"),
                                             F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("props"))
    few = fold(change_log(spark, sf).filter(F.col("_seq") < 50), LOG_SPEC)
    out = apply(base, few, LOG_SPEC, narrow=True)
    out.collect()
    final = plan(out).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_lookups_are_cut_to_the_keys_in_need_first(spark, sf):
    """The stored table is filtered by key before its data and deletes meet, reading key and open columns only."""
    root = work_dir(spark, "plans")
    folded = fold(change_log(spark, sf), LOG_SPEC).persist()
    from millrace.sinks import commits

    commits.commit_tables(spark, root, 0, tables.delta_writes(folded, LOG_SPEC), kind="delta")
    data, deletes = tables.read_parts(spark, root, LOG_SPEC)
    text = resolve_parts(folded, data, deletes, LOG_SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") == 2


def test_commit_filter_prunes_folders(spark, sf):
    from millrace.sinks import commits

    root = work_dir(spark, "plans")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for n in range(3):
        commits.commit_tables(spark, root, n, {"orders": rows.filter(F.col("o_orderkey") % 3 == n)})
    fresh = commits.read_table(spark, root, "orders", rows.schema, after=1).select("o_orderkey")
    text = plan(fresh)
    assert {f.split("_commit=")[1][0] for f in fresh.inputFiles()} == {"2"}
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    assert len(fresh.inputFiles()) and fresh.count() == rows.filter("o_orderkey % 3 = 2").count()


def test_rewrite_prunes_partition_folders_at_run_time(spark, sf):
    """Rows of untouched partitions are not read when a change set is merged."""
    from dataclasses import replace

    from millrace.operators.fold import as_folded, live
    from millrace.sinks import commits

    spec = replace(LOG_SPEC, partition=("bucket[4](user_id)",))
    root = work_dir(spark, "plans")
    rows = as_folded(live(fold(change_log(spark, sf), spec), spec), spec).persist()
    tables.merge_table(rows, spec, root, 0)
    few = spark.createDataFrame([("user_id_bucket=1",)], tables._TOUCHED)
    part = commits.write_part(few, root, tables.touched_name(spec), 1)
    listed = commits.read_parts(spark, root, tables.touched_name(spec), tables._TOUCHED, [part])
    inside = tables._stored_versions(spark, root, spec, commits.load(spark, root).upto(0)).join(listed.select(tables.PART), tables.PART, "left_semi")
    text = inside._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    named = tables._stored_versions(spark, root, spec, commits.load(spark, root).upto(0)).filter(F.col(tables.PART).isin("user_id_bucket=1"))
    filters = plan(named).partition("PartitionFilters: [")[2].partition("]")[0]
    assert "concat_ws" in filters and named.select(tables.PART).distinct().count() == 1
    assert {r[0] for r in inside.select(tables.PART).distinct().collect()} == {"user_id_bucket=1"}


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(load_all()["s5_watermark_poll"][0](spark, sf))
    assert "GreaterThan(ts," in text
    text = plan(load_all()["s8_key_scan"][0](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_sample_limits_before_the_shuffle(spark, sf):
    diff = table(spark, sf, "events").select("event_id", F.col("event_type").alias("category"))
    assert "WindowGroupLimit" in plan(diff_sample(diff, ["event_id"]))


def test_bulk_transaction_join_is_split(spark, conf):
    """One transaction holds most rows: adaptive execution splits its side of the join."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB")
    n = 200_000
    rows = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") < n // 10 * 9, 1).otherwise(F.col("id")).cast("bigint").alias("xid"),
        F.lit("INSERT").alias("op"), F.col("id").alias("lsn"), F.col("id").alias("pos"),
        F.lit(None).cast("timestamp").alias("source_ts"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    ends = rows.filter((F.col("pos") == 0) | (F.col("pos") >= n // 10 * 9)).withColumn("op", F.lit("COMMIT"))
    feed = rows.unionByName(ends)
    # Both with a fresh shuffle behind it and on its own the split must happen.
    gated = tx.committed_only(feed)
    assert gated.agg(F.count("*"), F.max("payload")).first()[0] == n
    out = gated.agg(F.count("*"), F.max("payload"))
    out.collect()
    assert "skew=true" in plan(out)


def test_busy_table_is_dealt_over_tasks(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rows = spark.range(0, 10_000, 1, 4).select(F.lit("t1").alias("table"), "id")
    keys = spark.createDataFrame([("t1",), ("t2",)], "table string")
    out = spread_join(rows, keys, ["table"], by=F.col("id"))
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 5_000


def generated(node):
    """Rows that the plan's explodes made."""
    own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
    return own + sum(generated(node.children().apply(i)) for i in range(node.children().size()))


def test_only_busy_relations_are_listed_more_than_once(spark, conf):
    """A set of relations may be as large as the feed: it is neither multiplied nor broadcast."""
    conf(spark__sql__adaptive__enabled="false")
    n = 20_000
    feed = spark.range(0, 2 * n, 1, 4).select(F.when(F.col("id") < n, 1).otherwise(F.col("id") - n).cast("bigint").alias("relation_id"), "id")
    out = known_relations(feed.unionByName(spark.sql("select cast(null as bigint) as relation_id, -1L as id")), spark.range(0, n, 2, 4).toDF("relation_id"))
    got = known_relations(feed, spark.range(1, n, 2, 4).toDF("relation_id")).count()
    assert got == n + n // 2 and sorted(r["id"] - n for r in out.collect()) == list(range(0, n, 2))
    assert generated(out._jdf.queryExecution().executedPlan()) <= n // 2 + 32
    semi = [line for line in plan(out).splitlines() if "Join" in line and "LeftSemi" in line]
    assert semi and all("SortMergeJoin" in line for line in semi)
