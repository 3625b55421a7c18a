"""Schema evolution: diff, apply, read old and new files under one schema, barriers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.spec import FIELD_ID, SchemaChange, TableSpec, spark_type


def schema_diff(old: Sequence[tuple[str, str]], new: Sequence[tuple[str, str]]) -> SchemaChange:
    """Difference by column name of two ``(name, source type)`` lists."""
    before, after = dict(old), dict(new)
    return SchemaChange(
        added=tuple((c, t) for c, t in new if c not in before),
        dropped=tuple(c for c, _ in old if c not in after),
        retyped=tuple((c, t) for c, t in new if c in before and before[c] != t),
    )


def catalog_diff(old: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same difference over column catalogs ``(…by, column, type)`` as rows."""
    keys = [*by, "column"]
    o = old.select(*keys, F.col("type").alias("old_type"))
    n = new.select(*keys, F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "dropped")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return o.join(n, keys, "full_outer").withColumn("change", change).filter(F.col("change").isNotNull())


def apply_changes(catalog: DataFrame, changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Apply ``(…by, column, change, new_type)`` rows to a column catalog."""
    keys = [*by, "column"]
    joined = catalog.join(changes.select(*keys, "change", "new_type"), keys, "full_outer")
    return joined.filter(F.col("change").isNull() | (F.col("change") != "dropped")).select(
        *keys, F.when(F.col("change").isNotNull(), F.col("new_type")).otherwise(F.col("type")).alias("type")
    )


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows written under an older schema, seen under ``spec``: by name, widened, missing as null."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spec.schema
    ])


def conform_ids(df: DataFrame, old: TableSpec, new: TableSpec) -> DataFrame:
    """Rows of ``old`` seen under ``new``, matched by field id like files are: a
    name that came back under a new id does not see the old values. Columns
    outside both specs pass through."""
    by_id = {old.field_id(c): c for c in old.columns}
    return df.select(
        *[F.col(c) for c in df.columns if c not in old.columns],
        *[
            (F.col(by_id[f.metadata[FIELD_ID]]) if f.metadata[FIELD_ID] in by_id else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in new.schema
        ],
    )


def read_evolved(spark: SparkSession, paths: Sequence[str], spec: TableSpec, **options) -> DataFrame:
    """Files of any earlier version under the current schema, matched by field id.

    Added columns are null in old files, dropped ones are not read, widened
    ones are widened by the Parquet reader, and a name that came back under a
    new id does not see the old values.
    """
    nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in spec.schema])
    reader = spark.read.schema(nullable)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.parquet(*paths)


def stamp_ids(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Attach the field ids of ``spec`` so that the Parquet writer records them.

    Ids inherited from wherever the rows were read are replaced; columns outside
    the spec follow and lose theirs.
    """
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name, metadata={FIELD_ID: f.metadata[FIELD_ID]})
            for f in spec.schema
        ],
        *[F.col(c).alias(c, metadata={}) for c in df.columns if c not in spec.columns],
    )


def split_at(events: DataFrame, at: int | Column, position: str = "_lsn") -> tuple[DataFrame, DataFrame]:
    """Events before a schema change (old schema) and from it on (new schema)."""
    edge = F.lit(at) if isinstance(at, int) else at
    return events.filter(F.col(position) < edge), events.filter(F.col(position) >= edge)


def stored_type(source_type: str) -> str:
    return spark_type(source_type).simpleString()
