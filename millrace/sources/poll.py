"""Watermark polls and chunked range scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def poll(df: DataFrame, watermark: str, last=None, lag: str | None = None) -> DataFrame:
    """Rows beyond the last watermark; the filter is pushed to the source.

    Null watermarks never match. ``last=None`` is the first poll. ``lag`` (an
    interval such as ``'5 minutes'``) reads a bit again, so rows that arrive
    late at or below the watermark are found; upserts make the repeat harmless.
    A text ``last`` is a mark of :func:`mark_of` and read as the column's own type,
    so no time zone of the driver comes in. Whole-number watermarks take a whole
    number as ``lag``.
    """
    wm = F.col(watermark)
    if last is None:
        return df.filter(wm.isNotNull())
    kind = df.schema[watermark].dataType
    edge = F.lit(last).cast(kind) if isinstance(last, str) else last if isinstance(last, Column) else F.lit(last)
    if lag is not None:
        edge = edge - (F.lit(int(lag)).cast(kind) if isinstance(kind, T.NumericType) else F.expr(f"interval {lag}"))
    return df.filter(wm > edge)


def mark_of(df: DataFrame, watermark: str) -> Column:
    """Highest watermark as text that casts back to the column's type: instants carry their offset."""
    top = F.max(watermark)
    if isinstance(df.schema[watermark].dataType, T.TimestampType):
        return F.date_format(top, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return top.cast("string")


def chunks(spark: SparkSession, lo: int, hi: int, width: int = 100_000) -> DataFrame:
    """Bounds ``[lo, hi)`` of key ranges that cover ``lo..hi``."""
    first = lo // width
    return spark.range(first, hi // width + 1).select(
        (F.col("id") * width).alias("lo"), ((F.col("id") + 1) * width).alias("hi")
    )


def with_chunk(df: DataFrame, key: str, width: int = 100_000) -> DataFrame:
    """Each row with the start of its key range."""
    return df.withColumn("chunk", (F.floor(F.col(key) / width) * width).cast("bigint"))
