"""Helpers shared by the operators: columns, crc32 of ids, folders, Arrow maps and connected components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import work_dir

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Rows that a function sees, and hands on, at once.
SLICE = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared checkpoint folder."""
    return f"{work_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: the plan above it is cut and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns of these names, whatever their case: an operator's own columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], add: StructType, hide: tuple[str, ...] = (),
    keeps=None, rows: int = SLICE,
) -> DataFrame:
    """Add columns made from each Arrow batch. ``fn`` gets an iterator of batches of at most ``rows`` rows and yields,
    batch by batch, one array per added field. Columns in ``hide`` are inputs that are not handed on; a kept column that clashes with an
    added one is replaced by it. What the worker keeps under another key than ``keeps`` is forgotten."""
    drop = {n.lower() for n in (*add.names, *hide)}
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in drop]
    schema = StructType([df.schema[i] for i in kept] + list(add.fields))

    def run(batches):
        forget(keeps)
        seen = []

        def feed():
            for b in batches:
                for at in range(0, b.num_rows, rows):
                    part = b.slice(at, rows)
                    seen.append(part)
                    yield part

        for arrays in fn(feed()):
            b = seen.pop(0)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in kept] + list(arrays), names=schema.names)

    return df.mapInArrow(run, schema)


def fields(**types) -> StructType:
    """Nullable fields by name and Spark type string."""
    return StructType([StructField(n, StructType.fromDDL(f"x {t}")[0].dataType) for n, t in types.items()])


def _keeps() -> dict:
    return sys.modules.setdefault("_millrace_llm_kept", types.ModuleType("_millrace_llm_kept")).__dict__.setdefault("held", {})


def forget(but=None) -> None:
    """Drop what this Python worker keeps from task to task under other keys than ``but``."""
    held = _keeps()
    for key in [k for k in held if k != but]:
        del held[key]


def kept(key, make: Callable):
    """The value of ``make()`` that this Python worker keeps from task to task under ``key``: what it has remembered of
    words need not be found again by the worker's next task. Only for values that bound their own size. A worker keeps
    one value: workers outlive the stage that filled them, and what they keep takes memory from the stages after it."""
    forget(key)
    held = _keeps()
    if key not in held:
        held[key] = make()
    return held[key]


def raw(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def partitions(spark: SparkSession, rows: int, each: int, most: int = 1 << 20) -> int:
    """How many partitions hold ``rows`` at ``each`` rows, at least the session's default parallelism."""
    return max(spark.sparkContext.defaultParallelism, min(most, -(-rows // each)))


#: Children of a node that go to one place, and links that a task of a round holds.
BUSY, LINKS = 2000, 500_000


class Forest:
    """Union-find over integers; roots are the least member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while up.get(r, r) != r:
            r = up[r]
        while x != r:
            up[x], x = r, up.get(x, x)
        return r

    def join(self, a: int, b: int) -> bool:
        """Link two trees; false if they were one."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _contract(batches):
    """Rows (node, other) of a task to its stars (a, b): each node under the least node it is linked with here. ``open``
    tells that some node had two parents, or a parent and children, so that another round is needed."""
    forest, parents, inner, open_ = Forest(), {}, set(), False
    for batch in batches:
        for node, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(node, other)
            if other < node:
                open_ = open_ or parents.setdefault(node, other) != other
            else:
                inner.add(node)
    open_ = open_ or any(n in parents for n in inner)
    nodes = list(forest.up)
    if nodes:
        roots = [forest.root(n) for n in nodes]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(roots, pa.int64()), pa.array([open_] * len(nodes))], names=["a", "b", "open"]
        )


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, component)`` with the least reachable node.

    Each round deals the links out by node, once by either end, and every task hangs its linked nodes on their least
    one; paths shrink by half at least. A node with more than ``BUSY`` children is cut into as many places as its children
    fill; its parents go to each of them. All other links are dealt once by either end, so the copies of a round are no
    more than one in ``BUSY`` links. Rounds are written to the shared folder. With ``rounds`` it stops early: labels are
    then of connected nodes, though a component may still have several."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"), "edges")
    done, zero = 0, F.lit(0).cast("long")
    while rounds is None or done < rounds:
        busy = edges.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > BUSY)
        busy = stored(busy.select(F.col("b").alias("node"), F.ceil(F.col("n") / BUSY).cast("long").alias("places")), "busy")
        down = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        up = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        if busy.isEmpty():
            dealt = up.unionByName(down).withColumn("salt", zero)
        else:
            salt = F.coalesce(F.pmod(F.xxhash64("other"), F.col("places")), zero)
            down = down.join(busy, "node", "left").select("node", "other", salt.alias("salt"))
            more = up.join(busy, "node").select("node", "other", F.explode(F.sequence(F.lit(1).cast("long"), F.col("places") - 1)).alias("salt"))
            dealt = down.unionByName(up.withColumn("salt", zero)).unionByName(more)
        places = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * edges.count() // LINKS))
        dealt = dealt.repartition(places, "node", "salt").select("node", "other")
        edges = stored(dealt.mapInArrow(_contract, "a long, b long, open boolean"), "edges")
        done += 1
        if rounds is None and edges.where("open").isEmpty():
            break
    stars = edges.groupBy("a").agg(F.min("b").alias("b"))
    roots = edges.select(F.col("b").alias("node")).distinct().join(stars.select(F.col("a").alias("node")), "node", "left_anti")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
