"""Transactions: commit gating, ordering, stamping and per-transaction reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.envelope import dml_only
from millrace.operators.spread import RANGES, with_range

NO_XID = 0  # rows outside any transaction, such as snapshot rows


def commits(feed: DataFrame) -> DataFrame:
    """One row per committed transaction: xid, commit position and time. A COMMIT
    that was sent twice counts once, at its last position.

    The xid comes out as an aggregate, so a join by it shuffles these few rows once
    more; a big side next to a shuffle of the join's own can be split where it is skewed.
    """
    return feed.filter(F.col("op") == "COMMIT").groupBy("xid").agg(
        F.max("xid").alias("_xid"), F.max("lsn").alias("commit_lsn"), F.max_by("source_ts", "lsn").alias("commit_ts")
    ).select(F.col("_xid").alias("xid"), "commit_lsn", "commit_ts")


def _committed(feed: DataFrame) -> DataFrame:
    """Ids of committed transactions, for joins that don't mind a repeat."""
    return feed.filter(F.col("op") == "COMMIT").select("xid")


def outside_transactions(feed: DataFrame) -> DataFrame:
    return dml_only(feed).filter(F.col("xid") == NO_XID)


def committed_only(feed: DataFrame) -> DataFrame:
    """DML of committed transactions, plus rows outside transactions.

    The commit side has one row per transaction; a transaction that holds a
    large share of all rows only makes the DML side big, which adaptive skew
    splitting divides (left side of a left-semi join).
    """
    rows = dml_only(feed)
    inside = rows.filter(F.col("xid") != NO_XID).join(_committed(feed), "xid", "left_semi")
    return inside.select(*feed.columns).unionByName(outside_transactions(feed))


def with_order(feed: DataFrame, stamp: bool = False) -> DataFrame:
    """Committed DML with its replay order: ``commit_lsn`` then ``pos``.

    The order is data, carried in two columns, so no sort is ever needed.
    Rows outside transactions stand at their own position (0 for a snapshot).
    ``stamp`` replaces ``source_ts`` by the transaction's commit time.
    """
    rows = dml_only(feed)
    joined = rows.filter(F.col("xid") != NO_XID).join(commits(feed), "xid", "inner")
    free = outside_transactions(feed).withColumns(
        {"commit_lsn": F.col("lsn"), "commit_ts": F.col("source_ts")}
    )
    out = joined.select(*feed.columns, "commit_lsn", "commit_ts").unionByName(free)
    if stamp:
        out = out.withColumn("source_ts", F.col("commit_ts"))
    return out


def order_key():
    return F.struct("commit_lsn", "pos")


def stamp_begin(feed: DataFrame) -> DataFrame:
    """Each DML row takes the time its transaction's BEGIN row announced."""
    begins = feed.filter(F.col("op") == "BEGIN").groupBy("xid").agg(F.min("source_ts").alias("_begin_ts"))
    inside = dml_only(feed).filter(F.col("xid") != NO_XID).join(begins, "xid", "left").select(
        *[c for c in feed.columns if c != "source_ts"],
        F.coalesce("_begin_ts", "source_ts").alias("source_ts"),
    )
    return inside.unionByName(outside_transactions(feed).select(*inside.columns))


def statement_numbers(rows: DataFrame, ranges: int = RANGES, name: str = "tx_seq") -> DataFrame:
    """Dense 1-based statement number inside each transaction, in ``pos`` order.

    One transaction may be a bulk load holding a third of all rows, so the log
    is cut into position ranges: rows are numbered inside a range, and a range
    starts where the counts of the transaction's earlier ranges end. A task
    sorts one range of rows, or the ``ranges`` counts of one transaction.
    """
    cut = with_range(rows, rows, "pos", "_range", ranges)
    sizes = cut.groupBy("xid", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("xid").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "xid", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("xid", "_range").orderBy("pos")
    return (
        cut.withColumn("_row", F.row_number().over(inside))
        .join(starts, ["xid", "_range"])
        .select(*rows.columns, (F.col("_start") + F.col("_row")).cast("bigint").alias(name))
    )


def flushed_position(feed: DataFrame) -> DataFrame:
    """Position that may be confirmed: the last commit, never a receipt."""
    return commits(feed).agg(F.max("commit_lsn").alias("flushed_lsn"), F.count("*").alias("transactions"))


def table_sets(feed: DataFrame) -> DataFrame:
    """Tables each transaction touches. Counting per (xid, table) first keeps
    the set small whatever the size of the transaction."""
    per_table = dml_only(feed).groupBy("xid", "table").agg(F.count("*").alias("n"))
    return per_table.groupBy("xid").agg(
        F.array_join(F.sort_array(F.collect_list("table")), ",").alias("tables"),
        F.sum("n").alias("rows"),
    )


def open_transactions(feed: DataFrame) -> DataFrame:
    """DML whose transaction has no COMMIT yet."""
    rows = dml_only(feed).filter(F.col("xid") != NO_XID)
    return rows.join(_committed(feed), "xid", "left_anti").select(*feed.columns)
