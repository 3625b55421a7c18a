"""Versions of table schemas, kept in the same commits as the rows they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.mor import COMMIT
from millrace.sinks import commits
from millrace.spec import SchemaChange, TableSpec

SCHEMAS = "schemas"
SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("from_lsn", T.LongType()),
    T.StructField("spec", T.StringType()),
])

Versions = list[tuple[int, TableSpec]]


def versions(spark: SparkSession, root: str, specs: Sequence[TableSpec], upto: int | None = None,
             log: commits.Log | None = None) -> dict[str, Versions]:
    """Per table its versions with the log position each starts at; a version's number is its place in the list, and the
    ``schema_id`` of commits. One row per schema change ever made reaches the driver."""
    parts = (log or commits.load(spark, root)).parts(SCHEMAS, upto=upto)
    rows = commits.read_parts(spark, root, SCHEMAS, SCHEMA, parts).orderBy("from_lsn", COMMIT).collect() if parts else []
    out = {s.name: [(-1, s)] for s in specs}
    for r in rows:
        if r["table"] in out:
            known = out[r["table"]]
            known.append((r["from_lsn"], known[0][1].with_json(r["spec"])))
    return out


def latest(spark: SparkSession, root: str, specs: Sequence[TableSpec], upto: int | None = None,
           log: commits.Log | None = None) -> list[TableSpec]:
    """Each table at its current version."""
    found = versions(spark, root, specs, upto, log)
    return [found[s.name][-1][1] for s in specs]


def at_commit(spark: SparkSession, root: str, spec: TableSpec, table: str, commit: int) -> TableSpec:
    """The version a commit of a table was written under, picked by the ``schema_id`` of its log entry."""
    log = commits.load(spark, root)
    entry = next((r for r in log.entries(table, commit - 1, commit)), None)
    if entry is None:
        raise ValueError(f"commit {commit} has no rows of {table}")
    return versions(spark, root, [spec], log=log)[spec.name][entry["schema_id"] or 0][1]


def changes_in(feed: DataFrame) -> list[tuple[str, int, SchemaChange]]:
    """Schema changes of a batch in log order: a handful of control rows."""
    rows = feed.filter(F.col("op") == "SCHEMA_CHANGE").select("table", "lsn", "after").orderBy("lsn").collect()
    return [(r["table"], r["lsn"], SchemaChange.from_map(r["after"])) for r in rows]


def advance(known: dict[str, Versions], changes: Sequence[tuple[str, int, SchemaChange]]) -> list[tuple[str, int, TableSpec]]:
    """Add the versions the changes make; returns the new ones. A change seen before is skipped."""
    new = []
    for table, lsn, change in changes:
        start, spec = known[table][-1]
        if lsn <= start or not change:
            continue
        known[table].append((lsn, spec.evolve(change)))
        new.append((table, lsn, known[table][-1][1]))
    return new


def as_rows(spark: SparkSession, new: Sequence[tuple[str, int, TableSpec]]) -> DataFrame:
    return spark.createDataFrame([(t, lsn, s.to_json()) for t, lsn, s in new], SCHEMA).coalesce(1)
