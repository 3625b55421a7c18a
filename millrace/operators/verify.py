"""Compare an expected table with an actual one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.names import pk_equal


def _compare(expected: DataFrame, actual: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Every key of either side with its category, null where both agree."""
    values = [c for c in expected.columns if c not in pk]
    e = expected.select(*pk, *values, F.lit(True).alias("_here")).alias("f")
    a = actual.select(*pk, *values, F.lit(True).alias("_here")).alias("b")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"b.{c}"))
    category = (
        F.when(F.col("b._here").isNull(), "missing")
        .when(F.col("f._here").isNull(), "extra")
        .when(~same, "wrong")
    )
    joined = e.join(a, pk_equal("f", "b", pk), "full_outer")
    return joined.select(
        *[F.when(F.col("f._here"), F.col(f"f.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in pk],
        category.alias("category"),
    )


def table_diff(expected: DataFrame, actual: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Differing keys with ``category``: missing, extra or wrong. Values compare null-safe."""
    return _compare(expected, actual, pk).filter(F.col("category").isNotNull())


def diff_summary(expected: DataFrame, actual: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row: totals, counts by category and the pass flag, all from one join."""
    missing, extra, wrong = (F.count_if(F.col("category") == c) for c in ("missing", "extra", "wrong"))
    rows = F.count("*")
    return _compare(expected, actual, pk).agg(
        (rows - extra).alias("expected_rows"), (rows - missing).alias("actual_rows"),
        missing.alias("missing_rows"), extra.alias("extra_rows"), wrong.alias("wrong_rows"),
        ((missing + extra + wrong) == 0).alias("pass"),
    )


def diff_sample(diff: DataFrame, pk: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` keys of each category: a top-k report.

    Spark limits each task to its own first ``n`` per category before the
    shuffle (window group limit), so no category is ever gathered whole.
    """
    w = Window.partitionBy("category").orderBy(*pk)
    return diff.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def missing_keys(source: DataFrame, log: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source keys absent from the change log. The log's keys are made unique
    first, map-side, so a key with very many events weighs no more than others."""
    return source.select(*key).join(log.select(*key).distinct(), list(key), "left_anti")


def order_ties(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Order keys that occur more than once; replay needs none."""
    return rows.groupBy(*order).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
