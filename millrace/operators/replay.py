"""Replay of logs into expected state, as aggregations instead of row-by-row loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.spread import RANGES, with_range


def replay_ops(ops: DataFrame, key: str = "seq", order: str = "id") -> DataFrame:
    """Operation log -> live ``(key, value)``.

    Inserts set, updates set only a present key, deletes remove; null values
    change nothing. A key lives iff its last non-null insert is after its last
    delete, and then its value is the last non-null one since.
    """
    valued = (F.col("op") != "delete") & F.col("value").isNotNull()
    state = ops.groupBy(key).agg(
        F.max_by("value", F.when(valued, F.col(order))).alias("value"),
        F.max(F.when((F.col("op") == "insert") & F.col("value").isNotNull(), F.col(order))).alias("_in"),
        F.max(F.when(F.col("op") == "delete", F.col(order))).alias("_out"),
    )
    return state.filter(F.col("_in").isNotNull() & (F.col("_out").isNull() | (F.col("_in") > F.col("_out")))
                        ).select(key, "value")


def replay_by_id(events: DataFrame, order: str = "_seq") -> DataFrame:
    """Change log keyed by ``id`` whose rows live under ``seq`` -> live ``(seq, value)``.

    Deletes name only the ``id``; the row they remove is the one that id wrote.
    Each ``seq`` belongs to one id, so the state is one aggregation per id,
    re-keyed at the end: alive iff the last insert is after the last delete, at
    the last ``seq`` and value written.
    """
    written = F.when(F.col("_op") != "D", F.col(order))
    state = events.groupBy("id").agg(
        F.max_by("seq", written).alias("seq"),
        F.max_by("value", written).alias("value"),
        F.max(F.when(F.col("_op") == "I", F.col(order))).alias("_in"),
        F.max(F.when(F.col("_op") == "D", F.col(order))).alias("_out"),
    )
    alive = F.col("_in").isNotNull() & (F.col("_out").isNull() | (F.col("_in") > F.col("_out")))
    return state.filter(alive).select("seq", "value")


def as_of(events: DataFrame, versions: DataFrame, by: str, at: str, payload: list[str],
          ranges: int = RANGES) -> DataFrame:
    """Each event with the latest version at or before it (``versions.at <= events.at``).

    Both sides are cut into ranges of ``at``. Inside a range a running last
    value answers; events before the range's first version take the last
    version of the nearest earlier range. A table that holds a third of all
    events is spread over its ranges, and only one summary row per range is
    ever put in order.
    """
    ev = with_range(events, events, at, "_r", ranges)
    ver = with_range(versions.select(by, at, F.struct(*payload).alias("_v")), events, at, "_r", ranges)

    # Ranges of either side, each with the last version inside it.
    summary = ver.groupBy(by, "_r").agg(F.max_by("_v", at).alias("_end")).unionByName(
        ev.select(by, "_r").distinct().withColumn("_end", F.lit(None).cast(ver.schema["_v"].dataType))
    ).groupBy(by, "_r").agg(F.max_by("_end", F.when(F.col("_end").isNotNull(), 1)).alias("_end"))
    earlier = Window.partitionBy(by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(by, "_r", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))

    cols = events.columns
    mixed = ev.withColumns({"_v": F.lit(None).cast(ver.schema["_v"].dataType), "_is": F.lit(1)}).unionByName(
        ver.withColumn("_is", F.lit(0)), allowMissingColumns=True
    )
    run = Window.partitionBy(by, "_r").orderBy(at, "_is").rowsBetween(Window.unboundedPreceding, 0)
    seen = mixed.withColumn("_v", F.last("_v", ignorenulls=True).over(run)).filter(F.col("_is") == 1)
    found = seen.join(carry, [by, "_r"], "left").withColumn("_v", F.coalesce("_v", "_carry"))
    return found.select(*cols, *[F.col(f"_v.{c}").alias(c) for c in payload])
