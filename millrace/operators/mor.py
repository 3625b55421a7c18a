"""Merge-on-read: data rows plus key deletes, each stamped with a commit number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.spec import TableSpec

COMMIT = "_commit"


def split(folded: DataFrame, spec: TableSpec, commit: int | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Folded state -> (equality deletes, data rows).

    Every folded key is deleted, also keys whose last operation is an insert:
    an insert is an upsert, so a key that exists already must not live twice.
    """
    stamp = [] if commit is None else [
        F.col(commit) if isinstance(commit, str) else F.lit(commit).cast("bigint").alias(COMMIT)
    ]
    deletes = folded.select(*stamp, *spec.pk)
    data = folded.filter(F.col("op") != "D").select(*stamp, *spec.columns)
    return deletes, data


def scan(data: DataFrame, deletes: DataFrame, pk: Sequence[str], as_of: int | None = None,
         nullable: Sequence[str] = ()) -> DataFrame:
    """Live rows: a data row dies iff its key is deleted by a later commit.

    Deletes shrink to the last one per key before the join. After a compaction
    they are few: Spark broadcasts them under its size limit and the data is
    not shuffled. A commit writes a key at most once, so no key has more data
    rows than there are commits and the join cannot be skewed by a hot key.
    ``nullable`` names key columns that may be null; there null matches null.
    """
    if as_of is not None:
        data, deletes = live_data(data, as_of), live_data(deletes, as_of)
    last = deletes.groupBy(*pk).agg(F.max(COMMIT).alias("_deleted"))
    rows = data.alias("f").join(last.alias("b"), keys_match(pk, nullable), "left")
    alive = F.col("_deleted").isNull() | (F.col("_deleted") <= F.col(f"f.{COMMIT}"))
    return rows.filter(alive).select(*[F.col(f"f.{c}").alias(c) for c in data.columns if c != COMMIT])


def keys_match(pk: Sequence[str], nullable: Sequence[str] = ()) -> Column:
    """Sides ``f`` and ``b`` have the same key. Plain equality lets a join reuse a partitioning, so only the
    ``nullable`` parts of a key, where null equals null, are compared null-safely."""
    cond = None
    for c in pk:
        f, b = F.col(f"f.{c}"), F.col(f"b.{c}")
        one = f.eqNullSafe(b) if c in nullable else f == b
        cond = one if cond is None else cond & one
    return cond


def live_data(data: DataFrame, commit: int) -> DataFrame:
    """Files visible at a commit; ``_commit`` is a partition column, so this prunes."""
    return data.filter(F.col(COMMIT) <= commit)


def between(events: DataFrame, last: int, upto: int | None = None) -> DataFrame:
    """Rows added after commit ``last`` (exclusive) up to ``upto`` (inclusive)."""
    rows = events.filter(F.col(COMMIT) > last)
    return rows if upto is None else rows.filter(F.col(COMMIT) <= upto)


def compact(data: DataFrame, deletes: DataFrame, pk: Sequence[str], commit: int) -> DataFrame:
    """The live rows as the only data of a new commit; its delete set is empty."""
    return scan(data, deletes, pk).select(F.lit(commit).cast("bigint").alias(COMMIT), "*")


def totals(data: DataFrame, deletes: DataFrame) -> DataFrame:
    """Data and delete rows per commit."""
    marked = data.select(COMMIT, F.lit(1).alias("d"), F.lit(0).alias("x")).unionByName(
        deletes.select(COMMIT, F.lit(0).alias("d"), F.lit(1).alias("x"))
    )
    return marked.groupBy(COMMIT).agg(
        F.sum("d").alias("data_rows"), F.sum("x").alias("delete_rows")
    )
