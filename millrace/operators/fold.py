"""Fold events into the final state of each key, in one grouped aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.names import unchanged_array
from millrace.spec import TableSpec


def known_flag(column: str) -> str:
    return f"known_{column}"


def fold(events: DataFrame, spec: TableSpec, order: str | Column = "_seq") -> DataFrame:
    """Final state per key: ``pk, op, seq, columns, known_<c>``.

    The last operation wins. Inserts and deletes replace the row; an update
    replaces it except for the columns it lists as unchanged, which keep the
    latest known value. Because inserts and deletes make every column known,
    that is one aggregate per column and needs no sort by time. A column no
    event of the batch makes known has ``known_<c>`` false and is looked up in
    the table by ``resolve`` or ``apply``.

    Aggregates combine map-side, so a key holding a large share of all events
    reaches the shuffle as one row per task. Each is a plain maximum over
    ``struct(order, value)``: the order decides, and a struct that stays null
    says that no event made the column known. Columns that can never be left
    out travel together in the first of them.
    """
    spec.require_pk()
    key = F.col(order) if isinstance(order, str) else order
    listed = "_unchanged" in events.columns
    rows = events if listed else events.withColumn("_unchanged", unchanged_array(F.col("_unchanged_cols")))
    rows = rows.filter(F.col("_op").isin("I", "U", "D")).withColumn("_order", key)
    open_cols = spec.resolvable
    plain = [c for c in spec.value_columns if c not in open_cols]

    aggs = [F.max(F.struct("_order", "_op", *plain)).alias("_last")]
    for c in open_cols:
        known = (F.col("_op") != "U") | ~F.array_contains("_unchanged", c)
        aggs.append(F.max(F.when(known, F.struct(F.col("_order"), F.col(c).alias("v")))).alias(c))
    folded = rows.groupBy(*spec.pk).agg(*aggs)
    return folded.select(
        *spec.pk,
        F.col("_last._op").alias("op"),
        F.col("_last._order").alias("seq"),
        *[F.col(f"_last.{c}").alias(c) if c in plain else F.col(f"{c}.v").alias(c) for c in spec.value_columns],
        *[F.col(c).isNotNull().alias(known_flag(c)) for c in open_cols],
    )


def live(folded: DataFrame, spec: TableSpec) -> DataFrame:
    """Current rows of a fold that started from an empty table."""
    return folded.filter(F.col("op") != "D").select(*spec.columns)


def as_folded(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Complete rows as upserts: what a poll or a snapshot contributes."""
    return rows.select(
        *spec.pk, F.lit("I").alias("op"), F.lit(0).cast("bigint").alias("seq"), *spec.value_columns,
        *[F.lit(True).alias(known_flag(c)) for c in spec.resolvable],
    )
