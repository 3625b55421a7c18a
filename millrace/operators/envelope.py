"""From raw feed rows to events: operation codes, row choice, tracked tables, parsing.

Raw feed rows: ``table, op, xid, lsn, pos, source_ts, proc_ts, before, after,
unchanged_cols``. ``before``/``after`` are structs (one typed table) or
``map<string,string>`` (several tables in one feed, values as text).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.casts import typed
from millrace.functions.names import unchanged_array, unchanged_csv
from millrace.operators.spread import spread_join
from millrace.spec import EVENT_META, TableSpec

# Operation names of the feed and their codes in the events table.
OP_CODES = {"INSERT": "I", "UPDATE": "U", "DELETE": "D"}
CONTROL_OPS = ("SNAPSHOT_TABLE_COMPLETE", "SNAPSHOT_COMPLETE", "BEGIN", "COMMIT", "SCHEMA_CHANGE")


def op_code(op: Column) -> Column:
    """INSERT/UPDATE/DELETE -> I/U/D; other names pass through."""
    out = op
    for name, code in OP_CODES.items():
        out = F.when(op == name, code).otherwise(out)
    return out


def dml_only(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("op").isin(*OP_CODES))


def tracked(feed: DataFrame, tables: DataFrame | Iterable[str]) -> DataFrame:
    """Keep rows of tracked tables. Control rows carry no table and stay.

    A Python list becomes a pushed-down predicate; a DataFrame becomes a
    left-semi join that deals the rows of a busy table over several tasks.
    """
    if isinstance(tables, DataFrame):
        control = feed.filter(F.col("table").isNull())
        rows = feed.filter(F.col("table").isNotNull())
        kept = spread_join(rows, tables.select("table").distinct(), ["table"])
        return kept.select(*feed.columns).unionByName(control)
    return feed.filter(F.col("table").isin(*tables) | F.col("table").isNull())


def known_relations(feed: DataFrame, relations: DataFrame, key: str = "relation_id") -> DataFrame:
    """Drop rows whose relation was never described."""
    return spread_join(feed, relations.select(key).distinct(), [key]).select(*feed.columns)


def _get(side: str, feed: DataFrame, spec: TableSpec, column: str) -> Column:
    dtype = feed.schema[side].dataType
    if isinstance(dtype, T.MapType):
        return typed(F.col(side)[column], spec.source_type(column))
    return F.col(f"{side}.{column}")


def _carried(feed: DataFrame, spec: TableSpec) -> Column:
    """An update under a new key, its unchanged columns filled from the before-image where that holds them."""
    listed = F.coalesce(F.col("unchanged_cols"), F.array().cast("array<string>"))
    is_map = isinstance(feed.schema["before"].dataType, T.MapType)
    found = {
        c: F.array_contains(listed, c) & (
            F.map_contains_key("before", c) if is_map else F.col(f"before.{c}").isNotNull())
        for c in spec.value_columns
    }
    fields = [
        F.when(found[c], _get("before", feed, spec, c)).otherwise(_get("after", feed, spec, c)).alias(c)
        if c in found else _get("after", feed, spec, c).alias(c)
        for c in spec.columns
    ]
    filled = F.array(*[F.when(found[c], c) for c in found]) if found else F.array().cast("array<string>")
    left = F.array_except(listed, filled)
    return F.struct(
        op_code(F.col("op")).alias("_op"), F.struct(*fields).alias("r"),
        unchanged_csv(F.when(F.size(left) > 0, left)).alias("_unchanged_cols"),
    )


def to_events(feed: DataFrame, spec: TableSpec, lsn: str = "lsn", seq: str = "pos") -> DataFrame:
    """Envelope -> events rows: after-image for I and U, before-image for D.

    An update that changes the key becomes a delete of the old key followed by
    the update under the new key; both keep the event's position, which is safe
    because their keys differ. The new key has no row to take unchanged columns
    from, so they come from the before-image as far as it holds them. Where a
    table's before-images are complete (``full_before_images``), that goes for
    every update: none leaves a column open, and the fold has nothing to look up.
    """
    rows = dml_only(feed)
    has_before = "before" in feed.columns
    is_delete = F.col("op") == "DELETE"

    def image(side: str) -> list[Column]:
        return [_get(side, feed, spec, c).alias(c) for c in spec.columns]

    after = F.struct(*image("after"))
    meta = [F.col(lsn).alias("_lsn"), F.col("source_ts").alias("_ts"), F.col(seq).alias("_seq")]
    if not has_before:
        one = F.struct(op_code(F.col("op")).alias("_op"), after.alias("r"),
                       unchanged_csv(F.col("unchanged_cols")).alias("_unchanged_cols"))
        parts = F.array(one)
    else:
        before = F.struct(*image("before"))
        main = F.struct(
            op_code(F.col("op")).alias("_op"),
            F.when(is_delete, before).otherwise(after).alias("r"),
            unchanged_csv(F.col("unchanged_cols")).alias("_unchanged_cols"),
        )
        moved = None
        for c in spec.pk:
            differs = ~_get("before", feed, spec, c).eqNullSafe(_get("after", feed, spec, c))
            moved = differs if moved is None else moved | differs
        if moved is None:
            parts = F.array(main)
        else:
            old = F.struct(
                F.lit("D").alias("_op"),
                F.struct(*[
                    (_get("before", feed, spec, c) if c in spec.pk
                     else F.lit(None).cast(spec.schema[c].dataType)).alias(c)
                    for c in spec.columns
                ]).alias("r"),
                F.lit(None).cast("string").alias("_unchanged_cols"),
            )
            moved = (F.col("op") == "UPDATE") & F.col("before").isNotNull() & moved
            parts = F.when(moved, F.array(old, _carried(feed, spec))).otherwise(F.array(main))
        if spec.full_before_images:
            whole = (F.col("op") == "UPDATE") & F.col("before").isNotNull()
            kept = F.when(whole, F.array(_carried(feed, spec))).otherwise(F.array(main))
            parts = kept if moved is None else F.when(moved, F.array(old, _carried(feed, spec))).otherwise(kept)
    return rows.select(*meta, F.inline(parts)).select(
        "_op", "_lsn", "_ts", "_seq", "_unchanged_cols", *[F.col(f"r.{c}").alias(c) for c in spec.columns]
    )


def parse_events(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Events rows -> typed metadata, unchanged list and user columns only."""
    return events.select(
        "_op", F.col("_lsn").cast("bigint").alias("_lsn"), F.col("_seq").cast("bigint").alias("_seq"),
        unchanged_array(F.col("_unchanged_cols")).alias("_unchanged"),
        *[F.col(c) for c in spec.columns],
    )


def user_columns(events: DataFrame) -> list[str]:
    return [c for c in events.columns if c not in EVENT_META and c != "_unchanged"]


def key_scan(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Only the key columns; the Parquet scan reads nothing else."""
    return df.select(*pk)
