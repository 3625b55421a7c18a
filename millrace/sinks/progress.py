"""Progress of pipelines: append a row per save, read the latest per pipeline, roll saves up now and then."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from millrace.operators.latest import latest_per_key
from millrace.sinks import files

# Fields of a progress record with their zero values.
EMPTY = {
    "mode": "", "lsn": 0, "snapshot_complete": False, "snapshotted_tables": [],
    "materialized": {}, "watermarks": {}, "snapshot_version": None,
}

SCHEMA = T.StructType([
    T.StructField("pipeline_id", T.StringType()),
    T.StructField("progress", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])


SAVE, ROLL_EVERY = "_save", 50


def _path(root: str) -> str:
    return f"{root}/_progress"


def _saves(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the stored saves, oldest first."""
    return sorted(int(n.partition("=")[2]) for n in files.names(spark, _path(root)) if n.startswith(f"{SAVE}="))


def _since(numbers: list[int]) -> list[int]:
    """The saves a reader needs: from the roll-up before the last one on, so that a save that was late for it counts."""
    rolled = [n for n in numbers if n % ROLL_EVERY == 0]
    return [n for n in numbers if len(rolled) < 2 or n >= rolled[-2]]


def save_progress(spark: SparkSession, root: str, pipeline_id: str, progress: dict,
                  at: datetime | None = None) -> None:
    """Append a row. Every ``ROLL_EVERY``-th save holds the latest row of every pipeline, and older ones are removed, so
    a reader opens at most twice that many files."""
    unknown = set(progress) - set(EMPTY)
    if unknown:
        raise ValueError(f"unknown progress fields {sorted(unknown)}")
    row = Row(pipeline_id=pipeline_id, progress=json.dumps({**EMPTY, **progress}, sort_keys=True),
              updated_at=at or datetime.now(timezone.utc))
    rows, numbers = spark.createDataFrame([row], SCHEMA), _saves(spark, root)
    number = max(numbers, default=-1) + 1
    if number and number % ROLL_EVERY == 0:
        rows = latest_progress(progress_table(spark, root).unionByName(rows))
    rows.coalesce(1).write.mode("append").parquet(f"{_path(root)}/{SAVE}={number}")
    if number % ROLL_EVERY == 0:
        keep = set(_since([*numbers, number]))
        for n in numbers:
            if n not in keep:
                files.remove(spark, f"{_path(root)}/{SAVE}={n}")


def progress_table(spark: SparkSession, root: str) -> DataFrame:
    """Latest row per pipeline."""
    paths = [f"{_path(root)}/{SAVE}={n}" for n in _since(_saves(spark, root))]
    return latest_progress(spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA))


def latest_progress(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["pipeline_id"], "updated_at")


def load_progress(spark: SparkSession, root: str, pipeline_id: str) -> dict:
    """Saved progress, or zero values for a new pipeline."""
    row = progress_table(spark, root).filter(F.col("pipeline_id") == pipeline_id).first()
    return dict(EMPTY) if row is None else {**EMPTY, **json.loads(row["progress"])}
