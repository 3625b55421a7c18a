"""Text to typed values and back, in the source's text forms. All expressions stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.spec import TableSpec, spark_type

# Fixed value: seconds between 1970-01-01 and the source's epoch 2000-01-01.
SOURCE_EPOCH_SECONDS = 946684800

TRUE_TEXTS = ("t", "true", "1")


def to_int(col: Column) -> Column:
    """Text or number to INT; fractions of numbers are cut, bad text is an error."""
    return col.cast("int")


def to_long(col: Column) -> Column:
    return col.cast("bigint")


def to_bool(col: Column) -> Column:
    """``t``, ``true`` and ``1`` are true, any other text is false, null stays null."""
    return col.isin(*TRUE_TEXTS)


def to_ts(col: Column) -> Column:
    """Text with optional fraction (cut to microseconds) and optional offset; none means UTC."""
    return col.cast("timestamp")


def to_date(col: Column) -> Column:
    return col.cast("date")


def to_bytes(col: Column) -> Column:
    r"""Binary from the source's ``\x..`` hex text."""
    return F.unhex(F.substring(col, 3, 2**31 - 4))


def typed(col: Column, source_type: str, strict: bool = True) -> Column:
    """One text column as its declared type. ``strict`` raises on bad text, else null."""
    target = spark_type(source_type)
    if isinstance(target, T.StringType):
        return col
    if isinstance(target, T.BooleanType):
        return to_bool(col)
    if isinstance(target, T.BinaryType):
        return to_bytes(col)
    if isinstance(target, T.TimestampNTZType):
        # Shift to UTC before the zone is dropped.
        ts = to_ts(col) if strict else col.try_cast("timestamp")
        return ts.cast(target)
    return col.cast(target) if strict else col.try_cast(target)


def typed_rows(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Cast every column of a text table to the types of ``spec``; other columns pass through."""
    return df.withColumns({
        c: typed(F.col(c), spec.source_type(c), strict) for c in spec.columns if c in df.columns
    })


def to_text(col: Column, source_type: str) -> Column:
    """A typed value in the source's text form."""
    target = spark_type(source_type)
    if isinstance(target, T.BooleanType):
        return F.when(col, "t").when(~col, "f")
    if isinstance(target, T.TimestampType):
        return F.concat(_trim_fraction(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")), F.lit("+00"))
    if isinstance(target, T.TimestampNTZType):
        return _trim_fraction(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if isinstance(target, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(col)))
    return col.cast("string")


def _trim_fraction(text: Column) -> Column:
    return F.regexp_replace(text, r"\.?0*$", "")


def days_since_epoch(col: Column) -> Column:
    return F.unix_date(F.to_date(col))


def from_source_epoch(micros: Column) -> Column:
    """Microseconds since the source's epoch -> timestamp."""
    return F.timestamp_micros(micros + F.lit(SOURCE_EPOCH_SECONDS * 1_000_000).cast("bigint"))


def required(col: Column, dtype: T.DataType) -> Column:
    """Replace null by the type's zero: 0, false, the epoch, empty text."""
    if isinstance(dtype, T.DateType):
        zero = F.lit("1970-01-01").cast("date")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        zero = F.lit("1970-01-01 00:00:00").cast(dtype)
    elif isinstance(dtype, T.BooleanType):
        zero = F.lit(False)
    elif isinstance(dtype, T.StringType):
        zero = F.lit("")
    elif isinstance(dtype, T.BinaryType):
        zero = F.lit(b"")
    else:
        zero = F.lit(0).cast(dtype)
    return F.coalesce(col, zero)


def fill_required(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Option, off by default: nulls of NOT NULL columns become typed zeros."""
    return df.withColumns({
        f.name: required(F.col(f.name), f.dataType)
        for f in spec.schema if not f.nullable and f.name in df.columns
    })


# -- log positions ----------------------------------------------------------


def lsn(text: Column) -> Column:
    """Log position text ``X/Y`` (two hex words) as a BIGINT."""
    words = F.split(text, "/")
    return (
        F.conv(words[0], 16, 10).cast("bigint") * F.lit(1 << 32).cast("bigint")
        + F.conv(words[1], 16, 10).cast("bigint")
    )


def lsn_text(position: Column) -> Column:
    high = F.shiftrightunsigned(position, 32)
    return F.concat_ws("/", F.hex(high), F.hex(position.bitwiseAND(F.lit(0xFFFFFFFF))))


def lag_bytes(current: Column, confirmed: Column) -> Column:
    """Bytes between two log positions given as text."""
    return lsn(current) - lsn(confirmed)


# -- sizes ------------------------------------------------------------------

# Estimated bytes of a non-null value by type name; others are
# text length plus a length word. Null counts 1.
FIXED_BYTES = {
    "boolean": 1, "short": 4, "integer": 4, "float": 4, "date": 4,
    "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8,
}


def row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of a row, used to size output files and flushes."""
    total = F.lit(0).cast("bigint")
    for f in schema:
        col = F.col(f.name)
        fixed = FIXED_BYTES.get(f.dataType.typeName())
        size = F.lit(fixed) if fixed else F.octet_length(
            col if isinstance(f.dataType, (T.StringType, T.BinaryType)) else col.cast("string")
        ) + 4
        total = total + F.when(col.isNull(), F.lit(1)).otherwise(size).cast("bigint")
    return total
