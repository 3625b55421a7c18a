"""Apply folded changes to a table: resolve unchanged columns, merge, route by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.names import pk_equal
from millrace.operators.fold import known_flag
from millrace.operators.mor import COMMIT, keys_match, scan
from millrace.spec import TableSpec


def _on(spec: TableSpec, null_safe: bool) -> Column:
    """Key columns declared NOT NULL are compared plainly, which lets the join reuse
    the partitioning of the fold; nullable ones, or all with ``null_safe``, null-safely."""
    return keys_match(spec.pk, spec.pk if null_safe else spec.nullable_keys)


def is_unresolved(spec: TableSpec) -> Column:
    """Folded updates with at least one column no event made known."""
    cond = F.lit(False)
    for c in spec.resolvable:
        cond = cond | ~F.col(known_flag(c))
    return (F.col("op") == "U") & cond


def unresolved(folded: DataFrame, spec: TableSpec) -> DataFrame:
    return folded.filter(is_unresolved(spec))


def resolve(folded: DataFrame, base: DataFrame, spec: TableSpec, null_safe: bool = False) -> DataFrame:
    """Fill unchanged columns from the current table; a key not found gives null.

    The table is read for key and resolvable columns only and cut to the keys
    that need it first: few such keys are broadcast under Spark's size limit
    and the table is not shuffled at all.
    """
    if not spec.resolvable:
        return folded
    need = unresolved(folded, spec).select(*spec.pk)
    hits = (
        base.select(*spec.pk, *spec.resolvable).alias("b")
        .join(need.alias("f"), _on(spec, null_safe), "left_semi")
    )
    return fill(folded, hits, spec, null_safe)


def resolve_parts(folded: DataFrame, data: DataFrame, deletes: DataFrame, spec: TableSpec) -> DataFrame:
    """``resolve`` against a merge-on-read table. Both its data and its deletes
    are cut to the needed keys before they meet, so the cost follows the change
    set, not the table."""
    if not spec.resolvable:
        return folded
    need = unresolved(folded, spec).select(*spec.pk)
    on = _on(spec, False)
    few_data = data.select(COMMIT, *spec.pk, *spec.resolvable).alias("f").join(need.alias("b"), on, "left_semi")
    few_deletes = deletes.select(COMMIT, *spec.pk).alias("f").join(need.alias("b"), on, "left_semi")
    return fill(folded, scan(few_data, few_deletes, spec.pk, nullable=spec.nullable_keys), spec)


def fill(folded: DataFrame, hits: DataFrame, spec: TableSpec, null_safe: bool = False) -> DataFrame:
    """Unknown columns from ``hits`` (one row per key), known ones as folded."""
    cols = spec.resolvable
    joined = folded.alias("f").join(hits.alias("b"), _on(spec, null_safe), "left")
    return joined.select(
        *[F.col(f"f.{c}").alias(c) for c in (*spec.pk, "op", "seq")],
        *[
            F.when(F.col(f"f.{known_flag(c)}"), F.col(f"f.{c}")).otherwise(F.col(f"b.{c}")).alias(c)
            if c in cols else F.col(f"f.{c}").alias(c)
            for c in spec.value_columns
        ],
        *[F.lit(True).alias(known_flag(c)) for c in cols],
    )


def apply(base: DataFrame, folded: DataFrame, spec: TableSpec, null_safe: bool = False,
          narrow: bool = False) -> DataFrame:
    """New table state: base rows minus deleted, with inserted and updated rows replaced.

    Both sides hold one row per key, so the join cannot be skewed by a hot key.
    The default is a single full outer join that also resolves unchanged
    columns. ``narrow`` is for a change set far smaller than the table: the
    table is only the probe side of joins against the change set, so Spark can
    broadcast the change set and leave the table where it is.
    """
    if narrow:
        return _apply_narrow(base, folded, spec, null_safe)
    joined = base.select(*spec.columns).alias("b").join(folded.alias("f"), _on(spec, null_safe), "full_outer")
    return _merged(joined, spec)


def _merged(joined: DataFrame, spec: TableSpec) -> DataFrame:
    untouched = F.col("f.op").isNull()

    def pick(c: str) -> Column:
        if c in spec.pk:
            return F.when(untouched, F.col(f"b.{c}")).otherwise(F.col(f"f.{c}"))
        keep_base = untouched
        if c in spec.resolvable:
            keep_base = untouched | ~F.col(f"f.{known_flag(c)}")
        return F.when(keep_base, F.col(f"b.{c}")).otherwise(F.col(f"f.{c}"))

    alive = joined.filter(untouched | (F.col("f.op") != "D"))
    return alive.select(*[pick(c).alias(c) for c in spec.columns])


def _apply_narrow(base: DataFrame, folded: DataFrame, spec: TableSpec, null_safe: bool) -> DataFrame:
    on = _on(spec, null_safe)
    kept = _merged(
        base.select(*spec.columns).alias("b").join(folded.alias("f"), on, "left"), spec
    )
    present = base.select(*spec.pk).alias("b").join(folded.select(*spec.pk).alias("f"), on, "left_semi")
    added = folded.filter(F.col("op") != "D").alias("f").join(present.alias("b"), on, "left_anti")
    return kept.unionByName(added.select(*spec.columns))


def affected(base: DataFrame, folded: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Base rows whose key is in the change set."""
    return base.join(folded.select(*pk), list(pk), "left_semi").select(*base.columns)


def touched_partitions(base: DataFrame, folded: DataFrame, spec: TableSpec,
                       parts: Sequence[str]) -> DataFrame:
    """Partitions a change set touches: where new rows go and where old rows live.

    ``base`` and ``folded`` carry the partition columns. Deletes may lack them,
    so old rows are located by key; only key and partition columns are read.
    """
    new = folded.filter(F.col("op") != "D").select(*parts)
    old = affected(base.select(*spec.pk, *parts), folded, spec.pk).select(*parts)
    return new.unionByName(old).distinct()


def restrict_to(df: DataFrame, partitions: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the given partitions (null-safe); prunes partitions at run time."""
    cond = pk_equal("d", "p", parts)
    return df.alias("d").join(partitions.alias("p"), cond, "left_semi")


def route_deletes(folded: DataFrame, base: DataFrame, spec: TableSpec,
                  parts: Sequence[str]) -> DataFrame:
    """Deletes with the partition their row lives in; unknown keys drop out."""
    gone = folded.filter(F.col("op") == "D").select(*spec.pk)
    return base.select(*spec.pk, *parts).join(gone, list(spec.pk), "left_semi")
