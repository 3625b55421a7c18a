"""Dividing work on busy keys: salted joins with small key sets, and position ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 32
#: A key with more than one in so many rows is busy.
BUSY_SHARE = 1024
RANGES = 1 << 14
SEGMENTS = 32


def spread_join(rows: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi",
                by: Column | None = None, salts: int = SALTS) -> DataFrame:
    """Join rows to a set of keys that has few rows per key (tables, relations).

    One key may hold a third of all rows, so rows of a busy key are dealt over
    ``salts`` groups and the key is listed once per group. Busy is what holds
    more than one in ``BUSY_SHARE`` rows, so there are fewer than ``BUSY_SHARE``
    such keys; all others are listed once, however many they are. Rows without
    a key match nothing and are dealt as well. ``by`` decides the group; by
    default all columns of the row.
    """
    seed = by if by is not None else F.xxhash64(*rows.columns)
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    counts = rows.filter(~missing).groupBy(*on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    busy = F.broadcast(counts.filter(F.col("_n") * BUSY_SHARE > total).select(*on, F.lit(True).alias("_busy")))
    dealt = rows.withColumn("_seed", seed).join(busy, list(on), "left").withColumn(
        "_salt", F.when(F.col("_busy") | missing, F.pmod("_seed", F.lit(salts))).otherwise(0).cast("int")).drop("_seed", "_busy")
    places = F.when(F.col("_busy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    listed = keys.join(busy, list(on), "left").withColumn("_salt", F.explode(places)).drop("_busy")
    return dealt.join(listed if how != "left_semi" else listed.hint("merge"), [*on, "_salt"], how).drop("_salt")


def with_range(rows: DataFrame, source: DataFrame, column: str, name: str = "_range", ranges: int = RANGES) -> DataFrame:
    """Add the number of the stretch of ``column`` a row falls in, at most about ``ranges`` of them; it never falls as
    the column rises.

    Approximate quantiles of ``source`` cut the rows into ``SEGMENTS`` parts of about equal count, and each part is cut
    evenly. So a few rows far from the others (snapshot rows at 0, log positions near 10^15) do not push all others
    into one stretch: none holds much more than one part of the rows. The bounds come from a scalar subquery that reads
    one column; a value beyond them falls in the first or last stretch.
    """
    cuts = [i / SEGMENTS for i in range(1, SEGMENTS)]
    bounds = source.agg(F.concat(
        F.array(F.min(column) - 1), F.percentile_approx(column, cuts, 20 * SEGMENTS), F.array(F.max(column))
    )).scalar()
    x, b, part = F.col(column), F.col("_bounds"), F.col("_part")
    each = max(1, ranges // SEGMENTS)
    inside = F.floor((x - F.get(b, part)) / F.greatest(F.get(b, part + 1) - F.get(b, part), F.lit(1)) * each)
    place = part * each + F.greatest(F.lit(0), F.least(F.lit(each - 1), F.coalesce(inside, F.lit(0))))
    return (
        rows.withColumn("_bounds", bounds)
        .withColumn("_part", F.greatest(F.size(F.filter(F.slice(b, 2, SEGMENTS - 1), lambda c: c < x)), F.lit(0)))
        .withColumn(name, place.cast("bigint"))
        .drop("_bounds", "_part")
    )
