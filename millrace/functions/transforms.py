"""Partition transforms: identity, year, month, day, hour, bucket[N], truncate[W]."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.hashing import murmur3_bytes, murmur3_fixed, murmur3_text, stepwise
from millrace.spec import FIELD_ID, TableSpec

NULL_PART = "__null__"

_EXPR = re.compile(r"\s*(?P<name>\w+)\s*(\[(?P<param>[^\]]*)\])?\s*\((?P<col>[^)]*)\)\s*")
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_INTEGRAL = (T.ShortType, T.IntegerType, T.LongType)
_BYTESLIKE = (T.StringType, T.BinaryType)
_BUCKETABLE = _INTEGRAL + _TEMPORAL + _BYTESLIKE + (T.DecimalType,)
_TRUNCATABLE = _INTEGRAL + _BYTESLIKE + (T.DecimalType,)
_NOT_BUCKETED_TEXT = ("json", "jsonb")


@dataclass(frozen=True)
class PartitionField:
    """One field of a partition spec: its column name and the transform that fills it."""

    name: str
    transform: str
    param: int | None
    source: str
    dtype: T.DataType
    source_id: int | None = None

    def column(self) -> Column:
        return transform(self.transform, self.param, F.col(self.source), self.dtype).alias(self.name)

    @property
    def result_type(self) -> T.DataType:
        return result_type(self.transform, self.dtype)


def parse(expr: str) -> tuple[str, int | None, str]:
    """``day(ts)``, ``bucket[16](id)`` or a bare column name -> (transform, parameter, column)."""
    text = expr.strip()
    if not text:
        raise ValueError("empty partition expression")
    if "(" not in text:
        return "identity", None, text
    m = _EXPR.fullmatch(text)
    if not m or not m["col"].strip():
        raise ValueError(f"invalid partition expression {expr!r}")
    param = None
    if m["param"] is not None:
        if not m["param"].strip().isdigit() or int(m["param"]) <= 0:
            raise ValueError(f"{expr!r}: parameter must be a positive integer")
        param = int(m["param"])
    return m["name"].lower(), param, m["col"].strip()


def partition_fields(exprs: Sequence[str], spec: TableSpec) -> list[PartitionField]:
    """Parse and check partition expressions against a table; raises ValueError."""
    out = []
    for expr in exprs:
        kind, param, col = parse(expr)
        if col not in spec.columns:
            raise ValueError(f"partition column {col!r} not found in {spec.name}")
        dtype, declared = spec.schema[col].dataType, spec.source_type(col)
        if kind in ("year", "month", "day", "hour"):
            ok = isinstance(dtype, _TEMPORAL)
        elif kind == "bucket":
            ok = isinstance(dtype, _BUCKETABLE) and declared not in _NOT_BUCKETED_TEXT
        elif kind == "truncate":
            ok = isinstance(dtype, _TRUNCATABLE) and declared not in _NOT_BUCKETED_TEXT + ("uuid",)
        elif kind == "identity":
            ok = True
        else:
            raise ValueError(f"unsupported partition transform {kind!r} in {expr!r}")
        if not ok:
            raise ValueError(f"{kind} does not apply to {col!r} ({declared})")
        if kind in ("bucket", "truncate") and param is None:
            raise ValueError(f"{kind} needs a positive integer parameter: {kind}[N]({col})")
        name = col if kind == "identity" else f"{col}_{kind}"
        out.append(PartitionField(name, kind, param, col, dtype,
                                  spec.schema[col].metadata.get(FIELD_ID)))
    return out


def partition_columns(exprs: Sequence[str], spec: TableSpec) -> list[Column]:
    return [f.column() for f in partition_fields(exprs, spec)]


def with_partitions(df: DataFrame, fields: Sequence[PartitionField]) -> DataFrame:
    """Add the derived partition columns (identity fields are already there)."""
    derived = {f.name: f.column() for f in fields if f.transform != "identity"}
    return df.withColumns(derived) if derived else df


def transform(kind: str, param: int | None, col: Column, dtype: T.DataType) -> Column:
    if kind == "identity":
        return col
    if kind == "year":
        return year(col)
    if kind == "month":
        return month(col)
    if kind == "day":
        return day(col)
    if kind == "hour":
        return hour(col)
    if kind == "bucket":
        return bucket(param, col, dtype)
    if kind == "truncate":
        return truncate(param, col, dtype)
    raise ValueError(f"unsupported partition transform {kind!r}")


def result_type(kind: str, dtype: T.DataType) -> T.DataType:
    """Type of a transform's value. Truncated binary is carried as path-safe text."""
    if kind in ("year", "month", "day", "hour", "bucket"):
        return T.IntegerType()
    if kind == "truncate" and isinstance(dtype, T.BinaryType):
        return T.StringType()
    if kind == "truncate" and isinstance(dtype, T.DecimalType):
        return _room_for_floor(dtype)
    return dtype


def _room_for_floor(dtype: T.DecimalType) -> T.DecimalType:
    # Flooring a negative value can need one more digit: -99.99 -> -100.00.
    return T.DecimalType(min(dtype.precision + 1, 38), dtype.scale)


def year(col: Column) -> Column:
    """Years since 1970."""
    return F.year(col) - 1970


def month(col: Column) -> Column:
    """Months since 1970-01."""
    return (F.year(col) - 1970) * 12 + F.month(col) - 1


def day(col: Column) -> Column:
    """Days since 1970-01-01, floored."""
    return F.unix_date(F.to_date(col))


def hour(col: Column) -> Column:
    """Hours since 1970-01-01, floored, in UTC."""
    return day(col) * 24 + F.hour(col.cast("timestamp"))


def bucket(n: int, col: Column, dtype: T.DataType, spec: bool = False) -> Column:
    """Hash bucket in [0, n). ``spec=True`` follows the table-format standard
    (integers widened to 8 bytes, signed decimals) instead of the default
    (4-byte integers, decimal magnitudes)."""
    if isinstance(dtype, T.DecimalType):
        h = stepwise(_decimal_bytes(col, dtype, signed=spec), murmur3_bytes)
    elif isinstance(dtype, T.BinaryType):
        h = murmur3_bytes(col)
    elif isinstance(dtype, T.StringType):
        h = murmur3_text(col)
    elif isinstance(dtype, T.TimestampNTZType):
        h = murmur3_fixed(col.cast("timestamp"))
    elif isinstance(dtype, (T.ShortType, T.IntegerType)):
        h = murmur3_fixed(col.cast("bigint" if spec else "int"))
    else:
        h = murmur3_fixed(col)
    value = (h.bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(n)).cast("int")
    return F.when(col.isNotNull(), value)


def truncate(width: int, col: Column, dtype: T.DataType) -> Column:
    """Integers and decimals floor to a multiple of ``width`` (in unscaled units),
    text keeps ``width`` code points, binary keeps ``width`` bytes as path-safe base64."""
    if isinstance(dtype, T.DecimalType):
        step = F.lit(width).cast("decimal(38,0)") if dtype.scale == 0 else F.expr(
            f"cast({width} as decimal(20,0)) * cast('1E-{dtype.scale}' as decimal(38,{dtype.scale}))"
        )
        wide = _room_for_floor(dtype)
        step = step.cast(wide)
        return (col.cast(wide) - F.pmod(col.cast(wide), step)).cast(wide)
    if isinstance(dtype, T.StringType):
        return F.substring(col, 1, width)
    if isinstance(dtype, T.BinaryType):
        text = F.base64(F.substring(col, 1, width))
        for raw, escaped in (("/", "%2F"), ("+", "%2B"), ("=", "%3D")):
            text = F.replace(text, F.lit(raw), F.lit(escaped))
        return text
    return col - F.pmod(col, F.lit(width).cast(dtype))


_PART = 1 << 60  # 15 hex digits


def _decimal_bytes(col: Column, dtype: T.DecimalType, signed: bool) -> Column:
    """Unscaled value as big-endian bytes: magnitude, or two's complement when signed."""
    unscaled = F.abs(col) if dtype.scale == 0 else F.abs(col) * F.expr(
        f"cast(1{'0' * dtype.scale} as decimal({dtype.scale + 1},0))"
    )
    if dtype.precision <= 18:
        magnitude = unscaled.cast("bigint")
        magnitude = F.when(col < 0, magnitude - 1).otherwise(magnitude) if signed else magnitude
        digits = F.hex(magnitude)
    else:
        # Digits as text: Spark's abs() rounds decimals beyond 34 digits.
        whole = F.regexp_replace(col.cast("string"), "[-.]", "").cast("decimal(38,0)")
        whole = F.when(col < 0, whole - 1).otherwise(whole).cast("decimal(38,0)") if signed else whole
        part = F.lit(_PART).cast("decimal(20,0)")

        def tail(value: Column) -> Column:
            return F.lpad(F.hex((value % part).cast("bigint")), 15, "0")

        digits = stepwise(whole, lambda w: F.struct(_div(w, part).alias("high"), tail(w).alias("low")),
                          lambda s: F.concat(F.hex(_div(s["high"], part).cast("bigint")), tail(s["high"]), s["low"]))
    even = (
        lambda x: F.ltrim(x, F.lit("0")),
        lambda x: F.when(F.length(x) % 2 == 1, F.concat(F.lit("0"), x)).otherwise(x),
    )
    if not signed:
        return F.unhex(stepwise(digits, *even))
    # A sign bit must lead: pad when the top bit is taken, then invert for negatives.
    digits = stepwise(digits, *even, lambda x: F.when(
        (x == "") | (F.substring(x, 1, 1) >= "8"), F.concat(F.lit("00"), x)).otherwise(x))
    inverted = F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")
    return F.unhex(F.when(col < 0, inverted).otherwise(digits))


def _div(value: Column, by: Column) -> Column:
    """Whole-number division of non-negative decimals."""
    return ((value - value % by) / by).cast("decimal(38,0)")


# -- paths -------------------------------------------------------------------


# Escapes of a value in a path, in the order they are made.
PATH_ESCAPES = (("%", "%25"), ("/", "%2F"), ("=", "%3D"))


def _is_safe(field: PartitionField | str) -> bool:
    """Binary is path-safe text already."""
    return not isinstance(field, str) and isinstance(field.dtype, T.BinaryType)


def partition_path(fields: Sequence[PartitionField] | Sequence[str]) -> Column:
    """``name=value/name=value`` from the partition columns, nulls as ``__null__``.

    ``%``, ``/`` and ``=`` inside a value are escaped, and so is a value that reads
    ``__null__`` itself, so every path has one reading."""
    def shown(f: PartitionField | str) -> Column:
        n = f if isinstance(f, str) else f.name
        text = F.col(n).cast("string")
        if not _is_safe(f):
            for mark, code in PATH_ESCAPES:
                text = F.replace(text, F.lit(mark), F.lit(code))
            text = F.when(text == NULL_PART, F.concat(F.lit("%5F"), F.substring(text, 2, len(NULL_PART)))).otherwise(text)
        return F.concat(F.lit(f"{n}="), F.coalesce(text, F.lit(NULL_PART)))

    return F.concat_ws("/", *[shown(f) for f in fields])


def parse_partition_path(path: Column, fields: Sequence[PartitionField]) -> Column:
    """Struct of typed partition values read back from a path."""
    parts = F.str_to_map(path, F.lit("/"), F.lit("="))

    def value(f: PartitionField) -> Column:
        text = F.nullif(F.element_at(parts, f.name), F.lit(NULL_PART))
        if not _is_safe(f):
            for mark, code in (("_", "%5F"), *reversed(PATH_ESCAPES)):
                text = F.replace(text, F.lit(code), F.lit(mark))
        return text.cast(f.result_type).alias(f.name)

    return F.struct(*[value(f) for f in fields])


def partition_dir(file_path: Column) -> Column:
    """Partition directory of a data file: what lies between ``/data/`` and the file name."""
    return F.regexp_extract(file_path, r"/data/(?:(.*)/)?[^/]*$", 1)
