"""Table names and unchanged-column lists as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def qualified(name: Column) -> Column:
    """Default schema ``public``; a ``public`` prefix in any case is normalized."""
    full = F.when(F.instr(name, ".") > 0, name).otherwise(F.concat(F.lit("public."), name))
    return F.regexp_replace(full, r"^(?i:public)\.", "public.")


def lake_name(name: Column) -> Column:
    """Last dotted part of a table name."""
    return F.substring_index(name, ".", -1)


def unchanged_csv(columns: Column) -> Column:
    """Array of column names -> comma list; empty or null array -> null."""
    return F.nullif(F.array_join(columns, ","), F.lit(""))


def unchanged_array(csv: Column) -> Column:
    """Comma list -> array; null or empty text -> empty array."""
    return F.when(F.coalesce(csv, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(csv, ",")
    )


def pk_equal(left: str, right: str, pk: Sequence[str]) -> Column:
    """Null-safe equality of all key columns of two aliased DataFrames."""
    cond = None
    for c in pk:
        one = F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        cond = one if cond is None else cond & one
    return cond


def pk_text(pk: Sequence[str]) -> Column:
    """Readable key for reports: parts joined by ``|``, null as empty. Never join on it."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in pk])
