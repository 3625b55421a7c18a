"""Reading a relational source over JDBC: range-parallel snapshots, polls, column discovery.

The driver class must be on the class path; nothing here opens a connection by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.spec import TableSpec, qualified

COLUMNS_QUERY = """
select c.column_name, c.data_type, c.is_nullable = 'YES' as nullable, c.ordinal_position as ord,
       k.ordinal_position as key_ord,
       (select r.relreplident = 'f' from pg_catalog.pg_class r join pg_catalog.pg_namespace n on n.oid = r.relnamespace
        where n.nspname = c.table_schema and r.relname = c.table_name) as full_before_images
from information_schema.columns c
left join information_schema.table_constraints t
  on t.table_schema = c.table_schema and t.table_name = c.table_name and t.constraint_type = 'PRIMARY KEY'
left join information_schema.key_column_usage k
  on k.constraint_name = t.constraint_name and k.table_schema = c.table_schema
 and k.table_name = c.table_name and k.column_name = c.column_name
where c.table_schema = '{schema}' and c.table_name = '{table}'
"""


def snapshot_options(url: str, table: str, key: str | None = None, lo: int = 0, hi: int = 0,
                     partitions: int = 1, fetch: int = 10_000) -> dict[str, str]:
    """Reader options; with a numeric key the table is read as parallel key ranges."""
    options = {"url": url, "dbtable": qualified(table), "fetchsize": str(fetch)}
    if key is not None:
        options |= {"partitionColumn": key, "lowerBound": str(lo), "upperBound": str(hi),
                    "numPartitions": str(partitions)}
    return options


def read_table(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**snapshot_options(url, table, **kw)).load()


def columns_query(table: str) -> str:
    schema, _, name = qualified(table).partition(".")
    if "'" in table:
        raise ValueError(f"bad table name {table!r}")
    return COLUMNS_QUERY.format(schema=schema, table=name).strip()


def discover(columns: DataFrame, table: str, pk: list[str] | None = None) -> TableSpec:
    """Spec from the rows of ``COLUMNS_QUERY``: a handful of catalog rows per table. The source's replica identity says
    whether updates come with their whole old row."""
    rows = columns.orderBy("ord").collect()
    if not rows:
        raise ValueError(f"table {table} not found")
    key = pk or [r["column_name"] for r in sorted(
        (r for r in rows if r["key_ord"] is not None), key=lambda r: r["key_ord"])]
    complete = "full_before_images" in columns.columns and bool(rows[0]["full_before_images"])
    return TableSpec.of(table, [(r["column_name"], r["data_type"], r["nullable"]) for r in rows], key, full_before_images=complete)


def profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns of a table against its data: ordinal, type, key position, nulls found.

    One pass over the table, one aggregate per column, unpivoted to a row each.
    """
    aggs = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in spec.columns])
    items = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(spec.source_type(c)).alias("type"),
            F.lit(spec.pk.index(c) + 1 if c in spec.pk else 0).alias("key_position"), F.col(c).alias("nulls"),
        )
        for i, c in enumerate(spec.columns, start=1)
    ]
    return aggs.select(F.inline(F.array(*items)))
