"""SimHash near-duplicates, verified through pivot distance tables.

Fingerprints are the majority bits of shingle hashes. Every fingerprint gets a table of Hamming distances to reference
fingerprints (pivots). Two fingerprints differ in at least as many bits as any coordinate of their tables does, so a
pair whose largest coordinate difference passes ``max_bits`` is dropped before its bits are compared; the others are
verified bit by bit.

Pairs are met without comparing all rows: of 6 bit blocks at most 4 can differ in a pair within 4 bits, so every such
pair agrees in some 2 of them (about 21 bits) and shares the bucket of those bits. This is exact, as it is for the 7 or 8
blocks that are taken when there are so many rows that buckets of more bits are needed. Rows with equal fingerprints are merged first; a large bucket is cut into cells, and each pair of cells is a task group of its
own, so a large group of near copies is spread over many tasks. What leaves a task is a spanning forest of its links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, arrow_map, components, fields, raw, stored

CELL = 2048
PIVOTS = 16
SEED = 42


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Majority bits of the XXH64 hashes of all ``shingle``-word runs, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    total, count = np.zeros(64, np.int64), len(stops)
    for at in range(0, count, 1 << 16):
        part = np.fromiter((hashed(line[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])), np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, hide: tuple[str, ...] = ()) -> DataFrame:
    """Add ``fp`` (long, the 64 bits) to each row; a null or blank text has fingerprint 0."""
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            bits = np.array([fingerprint(t, shingle) for t in raw(b.column(at))], np.uint64)
            yield [pa.array(bits.view(np.int64))]

    return arrow_map(docs.withColumn(text, F.col(text).cast("string")), run, fields(fp="long"), hide)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """``n`` reference fingerprints, fixed."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)], np.uint64)


def table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each reference, one column a reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def block_masks(blocks: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def survivors(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, tl: np.ndarray, tr: np.ndarray, max_bits: int):
    """Of the index pairs (i, j): drop those that differ by more in any pivot's distance, then verify the bits."""
    for k in range(tl.shape[1]):
        ok = np.abs(tl[i, k] - tr[j, k]) <= max_bits
        i, j = i[ok], j[ok]
    ok = np.bitwise_count(left[i] ^ right[j]) <= max_bits
    return i[ok], j[ok]


def runs_pairs(fps: np.ndarray, stop: np.ndarray, max_bits: int):
    """Close pairs inside runs of neighbouring rows; ``stop`` is where each row's run ends."""
    refs, at = pivots(), np.arange(len(fps))
    dist = table(fps, refs)
    k, live = 1, at[at + 1 < stop]
    while len(live):
        yield survivors(fps, fps, live, live + k, dist, dist, max_bits)
        k += 1
        live = live[live + k < stop[live]]


def cross_pairs(left: np.ndarray, right: np.ndarray, max_bits: int, rows: int = 128):
    """Close pairs between two lists: both are sorted by the first pivot's distance, so that a block of rows meets only
    the band of the other list that its first coordinates allow."""
    refs = pivots()
    left, right = (x[np.argsort(table(x, refs[:1])[:, 0], kind="stable")] for x in (left, right))
    tl, tr = table(left, refs), table(right, refs)
    first = tr[:, 0].astype(np.int16)
    for at in range(0, len(left), rows):
        part = tl[at : at + rows, 0].astype(np.int16)
        lo, hi = np.searchsorted(first, part[0] - max_bits), np.searchsorted(first, part[-1] + max_bits, "right")
        i, j = np.nonzero(np.abs(tl[at : at + rows, 1, None] - tr[None, lo:hi, 1]) <= max_bits)
        i, j = survivors(left, right, i + at, j + lo, tl, tr, max_bits)
        yield left[i], right[j]


def _groups(batches):
    """Arrow batches sorted by their first three columns, re-cut so that no group spans two pieces."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        cut = np.zeros(max(len(cols[0]) - 1, 0), bool)
        for c in cols[:3]:
            cut |= c[1:] != c[:-1]
        edges = np.flatnonzero(cut) + 1
        if held and len(cols[0]) and any(h[-1] != c[0] for h, c in zip(held[-1][:3], cols[:3])):
            yield [np.concatenate(x) for x in zip(*held)]
            held = []
        if len(edges):
            yield [np.concatenate(x) for x in zip(*held, [c[: edges[-1]] for c in cols])]
            held = [[c[edges[-1] :] for c in cols]]
        elif len(cols[0]):
            held.append(cols)
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _links(max_bits: int, small: int = 48):
    """Rows (bucket, x, y, side, fp, grp), sorted, to the links between groups that a task finds: a spanning forest, so
    no more of them than groups, however many rows are close."""

    def run(batches):
        forest = Forest()
        for bucket, x, y, side, fp, grp in _groups(batches):
            fps = fp.view(np.uint64)
            order = np.argsort(fps, kind="stable")
            named = lambda f: grp[order[np.searchsorted(fps[order], f)]].tolist()  # noqa: B023, E731
            edge = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)) + 1
            starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(fps)]])
            size = np.repeat(stops - starts, stops - starts)
            mine = (size <= small) & (side == 0)
            own = fps[mine]
            ends = np.searchsorted(np.repeat(np.arange(len(starts)), stops - starts)[mine], np.repeat(np.arange(len(starts)), stops - starts)[mine], "right")
            found = [(own[i], own[j]) for i, j in runs_pairs(own, ends, max_bits)]
            for a, b in zip(starts, stops):
                if b - a > small:
                    part, s = fps[a:b], side[a:b]
                    found += cross_pairs(part[s == 1], part[s == 0], max_bits)
            out = [(p, q) for a, b in found for p, q in zip(named(a), named(b)) if forest.join(p, q)]
            if out:
                p, q = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(q, pa.int64())], names=["a", "b"])

    return run


def _keyed(fps: DataFrame, agree: int, blocks: int) -> DataFrame:
    """Each row once for every choice of ``agree`` blocks, with the bucket of those blocks' bits."""
    masks = [sum(c) for c in combinations(block_masks(blocks), agree)]
    bits = F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks])
    return fps.select("*", F.posexplode(bits).alias("m", "part")).withColumn("bucket", F.xxhash64("m", "part")).drop("m", "part")


def _linked(rows: DataFrame, max_bits: int) -> DataFrame:
    rows = rows.select("bucket", "x", "y", "side", "fp", "grp")
    dealt = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "side", "fp")
    return dealt.mapInArrow(_links(max_bits), "a long, b long").distinct()


def links(fps: DataFrame, max_bits: int = 4, blocks: int = 6) -> tuple[DataFrame, DataFrame]:
    """Distinct fingerprints ``fp`` with a group ``grp`` each, and the links ``(a, b)`` between groups that are left.

    First pass: rows that differ inside one block only (a bucket holds at most one row per value of that block). They
    label the rows, as far as two rounds get. Second pass: all buckets, but only pairs of rows with different labels are left to
    find; per bucket the rows outside the most common label meet all rows, in cells of ``CELL``."""
    zero = F.lit(0)
    once = _keyed(fps, blocks - 1, blocks)
    first = stored(_linked(once.select("bucket", zero.alias("x"), zero.alias("y"), zero.alias("side"), "fp", F.col("fp").alias("grp")), max_bits), "links")
    names = components(first, rounds=2).withColumnRenamed("node", "fp")
    rows = stored(fps.join(names, "fp", "left").select("fp", F.coalesce("component", "fp").alias("grp")), "labelled")
    keyed = _keyed(rows, blocks - max_bits, blocks)
    per = keyed.groupBy("bucket", "grp").agg(F.count("*").alias("n"))
    sizes = per.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "grp")).alias("top"), F.count("*").alias("labels"))
    sizes = sizes.where("labels > 1").select(
        "bucket", F.col("top.grp").alias("major"),
        F.ceil(F.col("n") / CELL).cast("int").alias("cells"), F.ceil((F.col("n") - F.col("top.n")) / CELL).cast("int").alias("minors"),
    )
    met = keyed.join(sizes, "bucket")
    spread = lambda k: F.pmod(F.xxhash64(F.lit("cell"), "fp"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(zero, F.col(k) - 1))
    right = met.select("bucket", every("minors").alias("x"), spread("cells").alias("y"), zero.alias("side"), "fp", "grp")
    left = met.where("grp <> major").select("bucket", spread("minors").alias("x"), every("cells").alias("y"), (zero + 1).alias("side"), "fp", "grp")
    return rows, _linked(right.unionByName(left), max_bits)


def blocks_for(rows: int, max_bits: int) -> int:
    """The fewest blocks, from ``max_bits`` + 2 on, whose buckets hold about a thousand of so many rows or fewer: the more
    blocks agree, the more bits name a bucket. Any number of blocks over ``max_bits`` is exact."""
    blocks = max_bits + 2
    while blocks < 2 * max_bits and rows >> (64 * (blocks - max_bits) // blocks) > 1000:
        blocks += 1
    return blocks


def groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """``docs(doc_id, text, ...)`` with the text replaced by ``fp``, ``grp`` (a fingerprint that names the group) and
    ``component_id`` (the group's least id).

    Rows with a null id keep it and don't lower a group's id; a group without any id has a null component. Null, empty
    and blank texts share fingerprint 0 and are linked like others. Repeated rows stay, each with its group's id.
    """
    base = stored(fingerprints(docs, "text", shingle, ("text",)), "fps")
    reps = stored(base.groupBy("fp").agg(F.min("doc_id").alias("least")), "reps")
    rows, left = links(reps.select("fp"), max_bits, blocks or blocks_for(reps.count(), max_bits))
    found = components(left).withColumnsRenamed({"node": "grp", "component": "whole"})
    known = reps.join(rows, "fp").join(found, "grp", "left").select("fp", "least", F.coalesce("whole", "grp").alias("grp"))
    ids = known.groupBy("grp").agg(F.min("least").alias("component_id"))
    return base.join(known.join(ids, "grp").select("fp", "grp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """``docs`` less all but one row of each group of near copies; columns unchanged. The row of the least id stays (of
    rows that repeat this id, the one with the least hash of its columns); in a group without ids, the least hash."""
    key, names = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), docs.columns
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), key.alias("row"))
    first = groups(rows, shingle, max_bits, blocks).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = stored(first.groupBy("grp").agg(F.min("doc_id").alias("__id"), F.min("row").alias("__row"), F.count("*").alias("__n")).drop("grp"), "keep")
    # equal rows cannot be told apart by id and hash; they are dropped here only where a group has several rows of its id
    held = docs.withColumn("__key", key)
    kept = held.join(keep, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__row")), "inner")
    once = kept.where("__n = 1")
    if not keep.where("__n > 1").isEmpty():
        once = once.unionByName(kept.where("__n > 1").dropDuplicates(["__key", "__id"]))
    return once.select(*[F.col(f"`{c}`") for c in names])
