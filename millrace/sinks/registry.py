"""Tables added and removed while a feed runs: entries of the commit log that each batch reads with it.

An entry has no rows. Its note holds the table's columns, key and layout, or nothing when the table is removed; of the
entries of a table the last one counts. A table that comes with its rows is added by the commit that holds them, so a
batch sees both or neither.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from millrace.sinks import commits, events as event_sink
from millrace.sinks.commits import MARK, Log
from millrace.sources.snapshot import snapshot_scan
from millrace.spec import TableSpec, qualified, validate

PREFIX = "registry/"


def _note(spec: TableSpec) -> str:
    return json.dumps({"columns": json.loads(spec.to_json()), "pk": spec.pk, "partition": spec.partition, "watermark": spec.watermark,
                       "maybe_unchanged": spec.maybe_unchanged, "full_before_images": spec.full_before_images})


def _spec(name: str, note: str) -> TableSpec:
    held = json.loads(note)
    kept = TableSpec(name, TableSpec.schema_of(json.dumps(held["columns"])), tuple(held["pk"]), tuple(held["partition"]), held["watermark"],
                     None if held["maybe_unchanged"] is None else tuple(held["maybe_unchanged"]), held["full_before_images"])
    return kept.with_json(json.dumps(held["columns"]))


def current(specs: Sequence[TableSpec], log: Log) -> list[TableSpec]:
    """``specs`` with what the log adds and removes."""
    out = {s.name: s for s in specs}
    for r in log.rows:
        if r["table"].startswith(PREFIX) and r["kind"] == MARK:
            name = r["table"].removeprefix(PREFIX)
            if r["note"]:
                out[name] = _spec(name, r["note"])
            else:
                out.pop(name, None)
    return list(out.values())


def add_table(spark: SparkSession, root: str, specs: Sequence[TableSpec], spec: TableSpec, rows: DataFrame | None = None,
              as_of: Column | None = None) -> int:
    """Track a table from the next batch on. Its present ``rows`` go into the same commit, as a snapshot."""
    def once() -> int:
        log = commits.load(spark, root)
        known = current(specs, log)
        validate([s for s in known if s.name != spec.name] + [spec])
        if any(s.name == spec.name for s in known):
            raise ValueError(f"{spec.name} is tracked already")
        writes, parts = {}, {}
        if rows is not None:
            made, parts[spec.events_name] = event_sink.prepare_events(snapshot_scan(rows, spec, as_of), spec)
            writes[spec.events_name] = made
        return commits.commit_tables(
            spark, root, log.top + 1, writes, partition_by=parts, cluster=True, marks={PREFIX + spec.name: MARK},
            details={PREFIX + spec.name: {"note": _note(spec)}}, log=log)

    return commits.retry_commit(once)


def remove_table(spark: SparkSession, root: str, specs: Sequence[TableSpec], name: str) -> int:
    """Stop tracking a table; what is stored of it stays."""
    def once() -> int:
        log = commits.load(spark, root)
        full = qualified(name)
        if not any(s.name == full for s in current(specs, log)):
            raise ValueError(f"{full} is not tracked")
        return commits.commit_tables(spark, root, log.top + 1, {}, marks={PREFIX + full: MARK}, log=log)

    return commits.retry_commit(once)
