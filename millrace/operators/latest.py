"""Latest-row and maximum helpers used by polls, progress and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_per_key(df: DataFrame, pk: Sequence[str], order: str | Sequence[str] | Column) -> DataFrame:
    """One row per key, the greatest by ``order`` (several columns break ties).

    An aggregation, not a window: it combines map-side, so hot keys do not
    collect in one task.
    """
    if isinstance(order, Column):
        by = order
    else:
        names = [order] if isinstance(order, str) else list(order)
        by = F.struct(*names) if len(names) > 1 else F.col(names[0])
    rest = [c for c in df.columns if c not in pk]
    picked = df.groupBy(*pk).agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return picked.select(*[F.col(c) if c in pk else F.col(f"_row.{c}").alias(c) for c in df.columns])


def max_watermark(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.max(column).alias("watermark"))


def table_watermarks(tables: DataFrame, per_table: DataFrame, legacy) -> DataFrame:
    """Watermark per table, falling back to the single value old progress rows held."""
    return tables.join(per_table, "table", "left").select(
        "table", F.coalesce("watermark", F.lit(legacy).cast("timestamp_ntz")).alias("watermark")
    )
