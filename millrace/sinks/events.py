"""Append-only events tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.transforms import PartitionField, partition_fields, with_partitions
from millrace.operators.evolve import stamp_ids
from millrace.sinks.commits import Log, commit_tables, read_table
from millrace.spec import TableSpec

DEFAULT_PARTITION = ("day(_ts)",)


def event_partitions(spec: TableSpec, exprs: Sequence[str] = DEFAULT_PARTITION) -> list[PartitionField]:
    return partition_fields(exprs, TableSpec(spec.events_name, spec.events_schema()))


def prepare_events(df: DataFrame, spec: TableSpec, exprs: Sequence[str] = DEFAULT_PARTITION
                   ) -> tuple[DataFrame, list[str]]:
    """Events with field ids and their partition columns, default ``day(_ts)``."""
    fields = event_partitions(spec, exprs)
    events_spec = TableSpec(spec.events_name, spec.events_schema())
    out = with_partitions(stamp_ids(df.select(*events_spec.columns), events_spec), fields)
    return out, [f.name for f in fields]


def append_events(df: DataFrame, spec: TableSpec, root: str, batch_id: int,
                  exprs: Sequence[str] = DEFAULT_PARTITION, rows_per_file: int | None = None) -> None:
    """Append one batch as commit ``batch_id``; a batch that is there already is left as it is, and a commit of this
    number that came from elsewhere is refused before anything is written."""
    rows, parts = prepare_events(df, spec, exprs)
    commit_tables(df.sparkSession, root, batch_id, {spec.events_name: rows},
                  partition_by={spec.events_name: parts},
                  rows_per_file={spec.events_name: rows_per_file} if rows_per_file else None,
                  cluster=True, source=f"{spec.events_name}:{batch_id}")


def read_events(spark: SparkSession, root: str, spec: TableSpec, after: int = -1,
                upto: int | None = None, log: Log | None = None) -> DataFrame:
    """Visible events of commits in (after, upto]."""
    return read_table(spark, root, spec.events_name, spec.events_schema(), upto, after, log)
