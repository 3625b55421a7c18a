"""Full-table snapshots as insert rows, with completion markers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.casts import to_text
from millrace.spec import TableSpec, qualified, source_type_of


@dataclass(frozen=True)
class Pinned:
    """A source that can be read as of a version: its tables, its current version, and a table's rows at a version.

    The version is whatever the source calls one: a commit of lake tables, an exported snapshot's id, a time."""

    tables: Sequence[str]
    current: Callable[[], int | str]
    read: Callable[..., DataFrame]


def snapshot_scan(df: DataFrame, spec: TableSpec, as_of: Column) -> DataFrame:
    """Every row as an insert event at position 0, outside any transaction."""
    zero = F.lit(0).cast("bigint")
    return df.select(
        F.lit("I").alias("_op"), zero.alias("_lsn"), as_of.alias("_ts"), zero.alias("_seq"),
        F.lit(None).cast("string").alias("_unchanged_cols"), *spec.columns,
    )


def _rows(df: DataFrame, table: str, as_of: Column) -> DataFrame:
    texts = [x for f in df.schema for x in (F.lit(f.name), to_text(F.col(f.name), source_type_of(f.dataType)))]
    return df.select(*_meta("INSERT", table, as_of), F.create_map(*texts).alias("after"))


def _meta(op: str, table: str | None, as_of: Column) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    return [
        F.lit(table).cast("string").alias("table"), F.lit(op).alias("op"), zero.alias("xid"),
        zero.alias("lsn"), zero.alias("pos"), as_of.alias("source_ts"), as_of.alias("proc_ts"),
    ]


def _marker(spark: SparkSession, op: str, table: str | None, as_of: Column) -> DataFrame:
    return spark.range(1).select(*_meta(op, table, as_of), F.lit(None).cast("map<string,string>").alias("after"))


def pending_tables(tables: Iterable[str], done: Iterable[str] = (), skip: Iterable[str] = ()) -> list[str]:
    """Tables still to copy: not skipped by configuration and not finished before."""
    gone = {qualified(t) for t in done} | {qualified(t) for t in skip}
    return [t for t in tables if qualified(t) not in gone]


def select_tables(catalog: DataFrame, progress: DataFrame) -> DataFrame:
    """The same choice over a catalog ``(table, skip_snapshot)`` and progress ``(table, done)``."""
    finished = progress.filter(F.col("done")).select("table")
    return catalog.filter(~F.col("skip_snapshot")).join(finished, "table", "left_anti")


def snapshot_all(tables: Mapping[str, DataFrame], as_of: Column, done: Iterable[str] = (),
                 skip: Iterable[str] = ()) -> DataFrame:
    """One feed of all tables' rows (as text maps), a marker per table, one at the end.

    Already finished tables are left out, so an interrupted snapshot resumes.
    Spark reads the tables in parallel; each keeps its own scan partitions.
    """
    spark = next(iter(tables.values())).sparkSession
    out = None
    for name in pending_tables(tables, done, skip):
        full = qualified(name)
        part = _rows(tables[name], full, as_of).unionByName(
            _marker(spark, "SNAPSHOT_TABLE_COMPLETE", full, as_of))
        out = part if out is None else out.unionByName(part)
    end = _marker(spark, "SNAPSHOT_COMPLETE", None, as_of)
    return end if out is None else out.unionByName(end)
