"""Progress, lag and throughput as ordinary aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.spread import spread_join

# Upper bounds in seconds of the flush and materializer latency histograms.
FLUSH_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60, 120, 300)
MATERIALIZE_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60, 120)


def counts(feed: DataFrame, *by: str) -> DataFrame:
    return feed.groupBy(*by).agg(F.count("*").alias("n"))


def rows_per_bucket(events: DataFrame, by: Sequence[str], bucket: str = "1 hour", ts: str = "_ts",
                    size: Column | None = None) -> DataFrame:
    """Rows (and bytes, given a size expression) per time bucket."""
    aggs = [F.count("*").alias("n")]
    if size is not None:
        aggs.append(F.sum(size).alias("bytes"))
    return events.groupBy(F.window(ts, bucket).start.alias("bucket"), *by).agg(*aggs)


def materialization_lag(written: DataFrame, materialized: DataFrame) -> DataFrame:
    """Per table: last written position minus last materialized one (none counts as 0)."""
    w = written.groupBy("table").agg(F.max("_lsn").alias("events_lsn"))
    m = materialized.groupBy("table").agg(F.max("_lsn").alias("materialized_lsn"))
    done = F.coalesce("materialized_lsn", F.lit(0).cast("bigint"))
    return w.join(m, "table", "left").select(
        "table", "events_lsn", done.alias("materialized_lsn"), (F.col("events_lsn") - done).alias("lag")
    )


def watermark_lag(df: DataFrame, watermark: str, now: Column, *by: str) -> DataFrame:
    """Whole seconds between ``now`` and the highest watermark."""
    top = F.max(watermark)
    seconds = F.floor(
        (F.unix_micros(now.cast("timestamp")) - F.unix_micros(top.cast("timestamp"))) / 1_000_000
    )
    return df.groupBy(*by).agg(seconds.alias("lag_seconds"))


def delays(feed: DataFrame, *by: str, exact: bool = True) -> DataFrame:
    """Source-to-processing delay in whole seconds: count, min, max, median, p95.

    ``exact`` counts rows per (group, delay) first and takes the quantiles from the
    running counts, so no task ever holds a group's values; otherwise a bounded
    sketch is used.
    """
    d = F.unix_seconds(F.col("proc_ts").cast("timestamp")) - F.unix_seconds(F.col("source_ts").cast("timestamp"))
    rows = feed.select(*by, d.alias("d"))
    ends = (F.min("d").alias("min_delay"), F.max("d").alias("max_delay"))
    if not exact:
        return rows.groupBy(*by).agg(
            F.count("*").alias("n"), *ends,
            F.percentile_approx("d", 0.5).alias("p50_delay"), F.percentile_approx("d", 0.95).alias("p95_delay"))
    each = rows.groupBy(*by, "d").agg(F.count("*").alias("c"))
    known = F.when(F.col("d").isNotNull(), F.col("c")).otherwise(0)
    whole = Window.partitionBy(*by)
    running = whole.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    ranked = each.withColumns({"_at": F.sum(known).over(running), "_all": F.sum(known).over(whole)})

    def pct(p: float, name: str) -> Column:
        reached = (F.col("_at") >= F.ceil(F.lit(p) * F.col("_all"))) & F.col("d").isNotNull()
        return F.min(F.when(reached, F.col("d"))).alias(name)

    return ranked.groupBy(*by).agg(F.sum("c").alias("n"), *ends, pct(0.5, "p50_delay"), pct(0.95, "p95_delay"))


def histogram(df: DataFrame, value: str, bounds: Sequence[float], *by: str) -> DataFrame:
    """Cumulative counts per upper bound plus the total, one row per group."""
    aggs = [F.count_if(F.col(value) <= F.lit(b)).alias(f"le_{str(b).replace('.', '_')}") for b in bounds]
    return df.groupBy(*by).agg(*aggs, F.count(value).alias("total"))


def backlog(events: DataFrame, progress: DataFrame) -> DataFrame:
    """Events per table beyond the table's last materialized sequence."""
    joined = spread_join(events.select("table", "_seq"), progress.select("table", "last_seq"), ["table"], "left",
                         by=F.col("_seq"))
    behind = F.col("last_seq").isNull() | (F.col("_seq") > F.col("last_seq"))
    return joined.groupBy("table").agg(F.count_if(behind).alias("backlog"))


def snapshot_progress(feed: DataFrame) -> DataFrame:
    """Rows read per table and whether its completion marker arrived."""
    return feed.filter(F.col("table").isNotNull()).groupBy("table").agg(
        F.count_if(F.col("op") == "INSERT").alias("rows"),
        F.max(F.col("op") == "SNAPSHOT_TABLE_COMPLETE").alias("complete"),
    )
