"""Small literal feeds: helpers to write them down, and a row-by-row replay to check against."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace.operators.apply import apply
from millrace.operators.envelope import to_events
from millrace.operators.fold import fold
from millrace.sources.feed import FEED_SCHEMA

NOW = datetime(2025, 1, 1, tzinfo=timezone.utc)
NAMES = {"I": "INSERT", "U": "UPDATE", "D": "DELETE"}


def dml(spec, op, row, unchanged=(), before=None, xid=0, pos=0):
    """One feed row; values are text, as the source sends them."""
    row = {k: v for k, v in row.items()}
    image = (row if op == "D" else before, None if op == "D" else row)
    return (spec.name, NAMES[op], xid, pos, pos, NOW, NOW, image[0], image[1], list(unchanged) or None)


def control(op, xid, lsn, ts=NOW):
    return (None, op, xid, lsn, lsn, ts, ts, None, None, None)


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def numbered(spec, ops, start=1):
    """(op, row[, unchanged]) tuples -> feed rows with rising positions."""
    return [dml(spec, o[0], o[1], *(o[2:] or ()), pos=start + i) for i, o in enumerate(ops)]


def run_batches(spark, spec, batches):
    """Fold and apply each batch in turn, in memory; returns the final rows sorted by key."""
    state, pos = [], 1
    for ops in batches:
        events = to_events(feed(spark, numbered(spec, ops, pos)), spec)
        state = rows(apply(spark.createDataFrame(state, spec.schema), fold(events, spec), spec), spec)
        pos += len(ops)
    return state


def rows(df, spec, *cols):
    return [tuple(r) for r in df.select(*(cols or spec.columns)).orderBy(*spec.pk).collect()]


def replay(events, pk, columns):
    """Row-by-row truth: events are dicts with _op, _unchanged and columns, in order."""
    state = {}
    for e in events:
        key = tuple(e[c] for c in pk)
        if e["_op"] == "D":
            state.pop(key, None)
        elif e["_op"] == "I":
            state[key] = {c: e[c] for c in columns}
        else:
            old = state.get(key, {})
            state[key] = {c: old.get(c) if c in e["_unchanged"] else e[c] for c in columns}
    return state


lit = F.lit
