"""Change feeds as streams and as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Raw feed of several tables: row images as text maps, values in the source's text form.
FEED_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("xid", T.LongType()),
    T.StructField("lsn", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("source_ts", T.TimestampType()),
    T.StructField("proc_ts", T.TimestampType()),
    T.StructField("before", T.MapType(T.StringType(), T.StringType())),
    T.StructField("after", T.MapType(T.StringType(), T.StringType())),
    T.StructField("unchanged_cols", T.ArrayType(T.StringType())),
])


def read_feed(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA,
              files_per_batch: int | None = None, bytes_per_batch: str | None = None) -> DataFrame:
    """Feed files as a stream, oldest first; the position lives in the query's checkpoint."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def read_feed_batch(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
