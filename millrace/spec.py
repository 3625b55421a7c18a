"""Table descriptions: columns with stable field ids, keys, type mapping and checks."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

FIELD_ID = "parquet.field.id"
SOURCE_TYPE = "source_type"

# Source column type -> declared lake type.
LAKE_TYPES = {
    "smallint": "int", "int2": "int",
    "integer": "int", "int": "int", "int4": "int", "serial": "int",
    "bigint": "long", "int8": "long", "bigserial": "long",
    "real": "float", "float4": "float",
    "double precision": "double", "float8": "double",
    "numeric": "decimal(38,18)", "decimal": "decimal(38,18)",
    "boolean": "boolean", "bool": "boolean",
    "text": "string", "varchar": "string", "character varying": "string",
    "bpchar": "string", "char": "string", "character": "string", "name": "string",
    "bytea": "binary",
    "date": "date",
    "timestamp": "timestamp", "timestamp without time zone": "timestamp",
    "timestamptz": "timestamptz", "timestamp with time zone": "timestamptz",
    "uuid": "uuid",
    "json": "string", "jsonb": "string",
}

# Type numbers used by the source's change stream -> type name.
TYPE_NUMBERS = {
    16: "bool", 17: "bytea", 20: "int8", 21: "int2", 23: "int4", 25: "text",
    114: "json", 700: "float4", 701: "float8", 1042: "bpchar", 1043: "varchar",
    1082: "date", 1114: "timestamp", 1184: "timestamptz", 1700: "numeric",
    2950: "uuid", 3802: "jsonb",
}

# Declared lake type -> the Spark type a column is stored with. Undeclared
# numerics stay text so their scale survives.
_STORED = {
    "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "decimal(38,18)": T.StringType(),
    "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType(),
    "date": T.DateType(), "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(), "uuid": T.StringType(),
}

# Widenings a stored column may go through without rewriting old files.
_WIDER = {("integer", "long"), ("short", "integer"), ("short", "long"), ("float", "double")}

EVENT_META = ("_op", "_lsn", "_ts", "_seq", "_unchanged_cols")


def lake_type(source_type: str) -> str:
    return LAKE_TYPES.get(source_type.lower(), "string")


def spark_type(source_type: str) -> T.DataType:
    """Stored type of a source type; ``numeric(p,s)`` with declared digits is a decimal."""
    text = source_type.lower().strip()
    head, _, digits = text.partition("(")
    if head.strip() in ("numeric", "decimal") and digits:
        precision, _, scale = digits.rstrip(") ").partition(",")
        return T.DecimalType(int(precision), int(scale or 0))
    return _STORED[lake_type(head.strip())]


def lake_type_column(source_type: Column) -> Column:
    """``lake_type`` as a column expression: one literal map lookup per row."""
    pairs = [F.lit(x) for kv in LAKE_TYPES.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(source_type)), F.lit("string"))


def type_name_column(type_number: Column) -> Column:
    """Type number of the change stream -> type name, unknown numbers are text."""
    pairs = [F.lit(x) for kv in TYPE_NUMBERS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), type_number), F.lit("text"))


@dataclass(frozen=True)
class SchemaChange:
    """Columns added (name, source type), dropped (name) and retyped (name, source type)."""

    added: tuple[tuple[str, str], ...] = ()
    dropped: tuple[str, ...] = ()
    retyped: tuple[tuple[str, str], ...] = ()

    def __bool__(self) -> bool:
        return bool(self.added or self.dropped or self.retyped)

    def to_map(self) -> dict[str, str]:
        """As the row image of a SCHEMA_CHANGE feed row."""
        return {k: json.dumps(getattr(self, k)) for k in ("added", "dropped", "retyped")}

    @classmethod
    def from_map(cls, image: dict[str, str]) -> SchemaChange:
        lists = {k: json.loads(image.get(k) or "[]") for k in ("added", "dropped", "retyped")}
        return cls(tuple(map(tuple, lists["added"])), tuple(lists["dropped"]), tuple(map(tuple, lists["retyped"])))


def _field(name: str, source_type: str, nullable: bool, field_id: int) -> T.StructField:
    return T.StructField(
        name, spark_type(source_type), nullable, {FIELD_ID: field_id, SOURCE_TYPE: source_type}
    )


_SOURCE_NAMES = {
    "integer": "integer", "short": "smallint", "long": "bigint", "float": "real",
    "double": "double precision", "boolean": "boolean", "string": "text",
    "binary": "bytea", "date": "date", "timestamp": "timestamptz",
    "timestamp_ntz": "timestamp",
}


def source_type_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"numeric({dtype.precision},{dtype.scale})"
    return _SOURCE_NAMES.get(dtype.typeName(), "text")


@dataclass(frozen=True)
class TableSpec:
    """A replicated table.

    ``maybe_unchanged`` narrows which columns an update may leave out; columns
    outside it need no per-column bookkeeping in the fold. The default (None)
    is every non-key column, which is always safe.
    """

    name: str
    schema: T.StructType
    pk: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()
    watermark: str | None = None
    maybe_unchanged: tuple[str, ...] | None = None
    full_before_images: bool = False
    last_field_id: int = field(default=0)

    def __post_init__(self):
        names = self.schema.fieldNames()
        missing = [c for c in self.pk if c not in names]
        if missing:
            raise ValueError(f"{self.name}: key columns {missing} are not in the schema")
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: duplicate column names")
        top = max([f.metadata.get(FIELD_ID, 0) for f in self.schema], default=0)
        object.__setattr__(self, "last_field_id", max(self.last_field_id, top))

    # -- construction -----------------------------------------------------

    @classmethod
    def of(cls, name: str, columns: Sequence[tuple], pk: Iterable[str] = (), **kw) -> TableSpec:
        """From ``(name, source type[, nullable])`` tuples in ordinal order."""
        fields = [
            _field(c[0], c[1], c[2] if len(c) > 2 else True, i)
            for i, c in enumerate(columns, start=1)
        ]
        return cls(qualified(name), T.StructType(fields), tuple(pk), **kw)

    @classmethod
    def from_df(cls, df: DataFrame, name: str, pk: Iterable[str] = (), **kw) -> TableSpec:
        """From a DataFrame's schema; key order is the order given."""
        fields = [
            T.StructField(
                f.name, f.dataType, f.nullable,
                {FIELD_ID: i, SOURCE_TYPE: source_type_of(f.dataType)},
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
        return cls(qualified(name), T.StructType(fields), tuple(pk), **kw)

    # -- views ------------------------------------------------------------

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.pk]

    @property
    def resolvable(self) -> list[str]:
        """Columns whose value an update may leave out. None where before-images are complete: they fill them."""
        if self.full_before_images:
            return []
        if self.maybe_unchanged is None:
            return self.value_columns
        return [c for c in self.value_columns if c in self.maybe_unchanged]

    @property
    def nullable_keys(self) -> list[str]:
        """Key columns not declared NOT NULL."""
        return [c for c in self.pk if self.schema[c].nullable]

    @property
    def lake_name(self) -> str:
        return self.name.rsplit(".", 1)[-1]

    @property
    def events_name(self) -> str:
        return f"{self.lake_name}_events"

    def field_id(self, column: str) -> int:
        return self.schema[column].metadata[FIELD_ID]

    def source_type(self, column: str) -> str:
        f = self.schema[column]
        return f.metadata.get(SOURCE_TYPE) or source_type_of(f.dataType)

    def events_schema(self) -> T.StructType:
        """Schema of the append-only events table; user columns lose NOT NULL, ids move by 5."""
        meta = [
            T.StructField("_op", T.StringType(), False, {FIELD_ID: 1}),
            T.StructField("_lsn", T.LongType(), False, {FIELD_ID: 2}),
            T.StructField("_ts", T.TimestampType(), False, {FIELD_ID: 3}),
            T.StructField("_seq", T.LongType(), False, {FIELD_ID: 4}),
            T.StructField("_unchanged_cols", T.StringType(), True, {FIELD_ID: 5}),
        ]
        user = [
            T.StructField(f.name, f.dataType, True,
                          {**f.metadata, FIELD_ID: f.metadata[FIELD_ID] + len(meta)})
            for f in self.schema
        ]
        return T.StructType(meta + user)

    def require_pk(self) -> TableSpec:
        if not self.pk:
            raise ValueError(f"{self.name}: a primary key is required")
        return self

    # -- storage ----------------------------------------------------------

    def to_json(self) -> str:
        """What evolution changes: columns with their ids, and the highest id ever used."""
        return json.dumps({"schema": self.schema.jsonValue(), "last_field_id": self.last_field_id})

    @staticmethod
    def schema_of(text: str) -> T.StructType:
        """The columns of a stored version."""
        return T.StructType.fromJson(json.loads(text)["schema"])

    def with_json(self, text: str) -> TableSpec:
        """This table at the stored version of its columns."""
        stored = json.loads(text)
        return replace(self, schema=T.StructType.fromJson(stored["schema"]), last_field_id=stored["last_field_id"])

    # -- evolution --------------------------------------------------------

    def evolve(self, change: SchemaChange) -> TableSpec:
        """Apply one change. Added columns are nullable and get fresh, never reused ids."""
        fields = {f.name: f for f in self.schema}
        next_id = self.last_field_id
        for name in change.dropped:
            if name in self.pk:
                raise ValueError(f"{self.name}: cannot drop key column {name}")
            fields.pop(name, None)
        for name, new_type in change.retyped:
            if name not in fields:
                continue
            old = fields[name]
            stored = spark_type(new_type)
            if stored != old.dataType:
                step = (old.dataType.typeName(), stored.typeName())
                if step not in _WIDER and not _wider_decimal(old.dataType, stored):
                    raise ValueError(f"{self.name}.{name}: {step[0]} cannot become {step[1]}")
            fields[name] = T.StructField(
                name, stored, old.nullable, {**old.metadata, SOURCE_TYPE: new_type}
            )
        for name, source_type in change.added:
            if name in fields:
                raise ValueError(f"{self.name}: column {name} exists")
            next_id += 1
            fields[name] = _field(name, source_type, True, next_id)
        return replace(self, schema=T.StructType(list(fields.values())), last_field_id=next_id)

    def rename(self, old: str, new: str) -> TableSpec:
        """A rename reaches us as drop plus add, so old rows are null under the new name."""
        return self.evolve(SchemaChange(added=((new, self.source_type(old)),), dropped=(old,)))

    def is_noop(self, change: SchemaChange) -> bool:
        """True when the change alters source types but no stored type."""
        return not (change.added or change.dropped) and all(
            spark_type(t) == self.schema[c].dataType for c, t in change.retyped if c in self.columns
        )


def _wider_decimal(old: T.DataType, new: T.DataType) -> bool:
    return (
        isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType)
        and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    )


def qualified(name: str) -> str:
    """Names without a schema part belong to ``public``."""
    return name if "." in name else f"public.{name}"


def validate(specs: Sequence[TableSpec], mode: str = "logical") -> list[TableSpec]:
    """Checks over a set of tables: at least one, no duplicates, poll mode needs key and watermark."""
    problems = []
    if mode not in ("logical", "query"):
        problems.append(f"mode must be 'logical' or 'query', got {mode!r}")
    if not specs:
        problems.append("at least one table is required")
    seen, lake = set(), {}
    for spec in specs:
        if spec.name in seen:
            problems.append(f"duplicate table {spec.name!r}")
        seen.add(spec.name)
        if lake.setdefault(spec.lake_name, spec.name) != spec.name:
            problems.append(f"{spec.name}: table name {spec.lake_name!r} is taken by {lake[spec.lake_name]}")
        if mode == "query":
            if not spec.pk:
                problems.append(f"{spec.name}: primary key required in query mode")
            if not spec.watermark:
                problems.append(f"{spec.name}: watermark column required in query mode")
            elif spec.watermark not in spec.columns:
                problems.append(f"{spec.name}: watermark column {spec.watermark!r} not found")
    if problems:
        raise ValueError("; ".join(problems))
    return list(specs)


def materializable(specs: Sequence[TableSpec]) -> list[TableSpec]:
    """Tables without a key stay change logs only; they are never folded."""
    return [s for s in specs if s.pk]
