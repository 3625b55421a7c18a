"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], one JSON line out.

The total leaves out the streams (w rows): they restart a query several times and are there for their rows a second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402

from millrace.plans import load_all  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "m1_fold_state", "m2_resolve_unchanged", "m3_apply", "m3_apply_narrow", "m4_split_deletes_data",
    "m5_merge_on_read_scan", "m10_compact", "j1_replay_by_secondary_key", "j2_replay_operation_log",
    "j3_relation_as_of", "t1_committed_only", "t2_replay_in_commit_order", "t3_sequence_numbers",
    "a1_latest_per_key", "p2_typed_rows", "p11_event_envelope", "x6_bucket_int", "x7_bucket_bigint",
    "x8_bucket_text", "x9_bucket_decimal", "x10_truncate_bigint", "x12_truncate_decimal", "x14_validated_spec",
    "x17_rows_per_partition", "s2_snapshot_rows", "s10_chunked_scan", "v1_table_diff", "v2_diff_summary",
    "v4_replay_equals_table", "o1_rows_per_bucket", "o4_materialization_lag", "o9_backlog",
    "e5_widen_columns", "k1_append_events", "k3_merge_table", "m9_materialize_cycle",
    "w1_feed_to_events", "w2_continuous_materialization",
]
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def duck(sf_dir: str, cpus: str) -> "duckdb.DuckDBPyConnection":
    con = duckdb.connect()
    con.execute(f"set threads = {int(cpus)}")
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench")
    registry = load_all()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, base, con = {}, {}, duck(sf_dir, cpus)
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            registry[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        sql = registry[name][1]
        if sql is not None:
            start = time.perf_counter()
            con.execute(sql).fetchall()
            base[name] = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(t for n, t in times.items() if n[0] != "w"), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {n: int(rows / times[n]) for n in ("m1_fold_state", "m3_apply", "m5_merge_on_read_scan", "v1_table_diff", "w1_feed_to_events", "w2_continuous_materialization")},
        "duckdb": base, "duckdb_total": round(sum(base.values()), 3),
    }))


if __name__ == "__main__":
    main()
