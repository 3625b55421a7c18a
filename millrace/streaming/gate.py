"""Commit gating of a stream, with a time bound and an explicit output for what expires."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.envelope import dml_only
from millrace.operators.transactions import commits as commit_rows
from millrace.sinks import commits
from millrace.sources.feed import FEED_SCHEMA
from millrace.streaming.pipeline import stream_id

GATED, WAITING, SEEN = "gated", "gate_waiting", "gate_commits"
SEEN_SCHEMA = T.StructType([
    T.StructField("xid", T.LongType()), T.StructField("commit_lsn", T.LongType()),
    T.StructField("commit_ts", T.TimestampType()),
])
GATED_SCHEMA = T.StructType([*FEED_SCHEMA.fields, *SEEN_SCHEMA.fields[1:]])


def gate_batch(batch: DataFrame, batch_id: int, root: str, stream: str, within: str = "1 hour") -> None:
    """One micro-batch: rows leave with their COMMIT, or as expired (``commit_lsn`` null) once the newest
    time seen is more than ``within`` ahead of them. Waiting rows are a table of the same commit, not operator state, and
    every commit ever seen is kept in one that is only appended to, so no row is dropped for being late and none is called
    expired whose transaction has committed: it meets its COMMIT first, whichever of the two came earlier and however far
    apart, and only then is its age looked at. Of the old commits a batch reads those in the range of transaction numbers
    that its unmatched rows span."""
    spark = batch.sparkSession
    source = f"{stream}:{batch_id}"
    log = commits.load(spark, root)
    if log.find(source) is not None:
        return
    feed = batch.select(*FEED_SCHEMA.names)
    waiting = commits.read_parts(spark, root, WAITING, FEED_SCHEMA, log.parts(WAITING)[-1:]).select(*FEED_SCHEMA.names)
    fresh = commit_rows(feed).select(*SEEN_SCHEMA.names)
    rows = dml_only(feed).unionByName(waiting)
    joined = rows.join(fresh, "xid", "left").select(*GATED_SCHEMA.names).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        newest, lo, hi = feed.select("source_ts", F.lit(None).cast("long").alias("xid")).unionByName(
            joined.filter(F.col("commit_lsn").isNull()).select("source_ts", "xid")).agg(
            F.date_format(F.max("source_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"), F.min("xid"), F.max("xid")).first()
        clock = max((c for c in (newest, *[r["note"] for r in log.entries(SEEN)[-1:]]) if c is not None), default=None)
        known = joined
        if lo is not None and log.parts(SEEN):
            old = commits.read_table(spark, root, SEEN, SEEN_SCHEMA, log=log).filter(F.col("xid").between(lo, hi))
            old = old.groupBy("xid").agg(F.max("commit_lsn").alias("_lsn"), F.max("commit_ts").alias("_ts"))
            known = joined.join(old, "xid", "left").withColumns({
                "commit_lsn": F.coalesce("commit_lsn", "_lsn"), "commit_ts": F.coalesce("commit_ts", "_ts")}).select(*GATED_SCHEMA.names)
        edge = F.lit(clock).cast("timestamp") - F.expr(f"interval {within}")
        out = F.col("commit_lsn").isNotNull() | F.coalesce(F.col("source_ts") < edge, F.lit(False))
        commits.commit_tables(spark, root, log.top + 1, {
            GATED: known.filter(out),
            WAITING: known.filter(~out).select(*FEED_SCHEMA.names),
            SEEN: fresh,
        }, kind={GATED: "append", WAITING: "list", SEEN: "append"}, source=source, details={SEEN: {"note": clock}}, log=log)
    finally:
        joined.unpersist()


def run_gate(feed: DataFrame, root: str, checkpoint: str, within: str = "1 hour", **trigger) -> StreamingQuery:
    """Start the gate over a feed; results are read with :func:`read_gated`."""
    def each(batch: DataFrame, batch_id: int) -> None:
        gate_batch(batch, batch_id, root, stream_id(batch.sparkSession, checkpoint), within)

    return (
        feed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_gated(spark: SparkSession, root: str) -> DataFrame:
    """Rows that left the gate; ``commit_lsn`` is null for the expired."""
    return commits.read_table(spark, root, GATED, GATED_SCHEMA).select(*GATED_SCHEMA.names)
