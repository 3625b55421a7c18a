"""Prefix trie of conversations by truncation peeling.

A conversation is the sequence of its turns (role, text); each distinct sequence of first turns is a node. Nodes are found
from the deepest turn up: at a depth the sequences that end there join those that survive from below, equal ones (which
are neighbours, because sequences are sorted) merge into a node and pass their sums on, the last turn is stripped, and the
rest is grouped again one turn higher. Each depth is visited once, and each node's figures are ready when it is found.

Turns are named by 128-bit digests of role and text, so texts leave the plan early. Sequences are dealt by ranges, which
splits a prefix that very many conversations share, and every task peels its own run. Only nodes on the path of a run's
first or last sequence can be shared with a neighbouring run; their partial sums leave the run as two *fringes* (a path with
the sums of its depths), which are the rows of the next round. A round has two rows for each run of the round before, so a
few rounds end in one run, which finishes the nodes all others share.

Conversations with equal sequences are one row with a count; their ids meet, sorted by Spark, in a streamed digest. No
conversation is collected to find the order of its turns: rows are sorted by ranges, numbered in each range, and shifted
by the counts of the ranges before. Its path, 16 bytes a turn, is one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, stored, text_of

#: Paths of a run (and turns in it), fringes that are peeled as one last run, rows of a range of turns.
RUN, RUN_TURNS, LAST, RANGE = 20_000, 1_000_000, 4096, 200_000
EMPTY = hashlib.sha256(b"").hexdigest()
HEAD = 9
BIG = np.iinfo(np.int64).max


# -- turns in order ----------------------------------------------------------


def turns(rows: DataFrame) -> DataFrame:
    """Turns as (c, pos, turn, size): position from 1 by turn (null first), then digest; digest of role and text; bytes
    of the text. Rows without a conversation id belong to no conversation."""
    role, text = text_of("role"), text_of("text")
    named = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    slim = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("at"), named.alias("turn"),
        F.octet_length(text).cast("long").alias("size"))
    slim = stored(slim, "turns")
    count = slim.count()
    # Rows that are equal in all three columns can't be told apart, but a range may cut between them by the last one.
    keys = [F.col("c"), F.col("at").asc_nulls_first(), F.col("turn"), F.col("mix")]
    dealt = slim.withColumn("mix", F.rand(7)).repartitionByRange(partitions(rows.sparkSession, count, RANGE), *keys)
    placed = dealt.sortWithinPartitions(*keys).drop("mix").withColumn("row", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.shiftright("row", 33)), "placed")
    per = placed.groupBy("c", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = per.select("c", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    placed = placed.join(shift, ["c", "part"])
    return stored(placed.select("c", (F.col("row") + F.col("shift")).alias("pos"), "turn", "size", "part"), "ordered")


def family(ordered: DataFrame, width: int = 5, heads: int = HEAD) -> DataFrame:
    """Conversations rebuilt: the first ``h`` turns are those of the family's head, c - c % ``width`` (all if it has fewer,
    none if it is absent), the rest are the conversation's own turns after its first ``h``; ``h`` is crc32(c) % ``heads``.
    Rows as of :func:`turns`; a conversation without any turn left has one row with null ``pos``."""
    sizes = ordered.groupBy("c").agg(F.count("*").alias("n")).withColumns({
        "head": F.col("c") - F.col("c") % width, "h": F.crc32(F.col("c").cast("string").cast("binary")) % heads})
    head_n = sizes.select(F.col("c").alias("head"), F.col("n").alias("head_n"))
    # Only heads are other conversations' heads, so at most ``width`` rows meet each of them.
    sizes = stored(sizes.join(head_n, "head", "left").select(
        "c", "n", "head", "h", F.least("h", F.coalesce("head_n", F.lit(0))).alias("given")), "sizes")
    # The part of a row is joined too, so that a conversation with very many turns is dealt by its ranges.
    parts = ordered.select("c", "part").distinct().join(sizes, "c")
    own = ordered.join(parts, ["c", "part"]).where("pos > h").select(
        "c", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "turn", "size")
    lent = ordered.where((F.col("pos") < heads) & (F.col("c") % width == 0)).select(F.col("c").alias("head"), "pos", "turn", "size")
    lent = lent.join(sizes.where("given > 0").select("c", "head", "given"), "head").where("pos <= given").select("c", "pos", "turn", "size")
    left = F.col("given") + F.greatest(F.lit(0), F.col("n") - F.col("h"))
    none = sizes.where(left == 0).select("c", *[F.lit(None).cast(t).alias(x) for x, t in (("pos", "long"), ("turn", "binary"), ("size", "long"))])
    return own.unionByName(lent).unionByName(none)


def paths(rebuilt: DataFrame) -> DataFrame:
    """Distinct sequences: path (digests), sizes, the number of conversations that are this sequence, the least of them,
    and the digest of all of them."""
    step = F.array_sort(F.collect_list(F.struct("pos", "turn", "size")))
    whole = rebuilt.groupBy("c").agg(step.alias("steps")).select(
        "c", F.expr("transform(filter(steps, x -> x.pos is not null), x -> x.turn)").alias("path"),
        F.expr("transform(filter(steps, x -> x.pos is not null), x -> x.size)").alias("sizes"))
    whole = stored(whole, "paths")
    named = whole.select(F.md5(F.array_join(F.transform("path", F.hex), "").cast("binary")).alias("name"), "c")
    ended = named.repartition("name").sortWithinPartitions("name", "c").mapInArrow(_ended, "c long, n long, ends string")
    return whole.join(ended, "c")


def _ended(batches):
    """Sorted rows (name, c) to (least c, count, SHA-256 of the ids joined by commas), one row a name, streamed."""
    out, now, first, n, digest = [], None, 0, 0, None
    for b in batches:
        for name, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if name != now:
                if now is not None:
                    out.append((first, n, digest.hexdigest()))
                now, first, n, digest = name, c, 0, hashlib.sha256()
            digest.update(b",%d" % c if n else b"%d" % c)
            n += 1
        if len(out) >= 10_000:
            yield _ends(out)
            out = []
    if now is not None:
        out.append((first, n, digest.hexdigest()))
    if out:
        yield _ends(out)


def _ends(rows):
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["c", "n", "ends"])


# -- peeling -----------------------------------------------------------------

#: A row of a round: a path and, per depth from 0, the sums that are known of the node there, its children's ends not yet
#: among them. ``n`` conversations that end there or pass through finished children, ``least`` of them, ``kids`` and
#: ``leaves`` of finished children, ``saved`` below, ``ends`` of the conversations that end there.
ROWS = ("path array<binary>, sizes array<long>, n array<long>, least array<long>, kids array<long>, leaves array<long>, "
        "saved array<long>, ends array<string>")
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, key binary, parent_key binary")
SUMS = ("n", "least", "kids", "leaves", "saved")
NONE = {"n": 0, "least": BIG, "kids": 0, "leaves": 0, "saved": 0}


class Run:
    """Sorted paths of a run, with their sums, and the peeling of them."""

    def __init__(self, table: pa.Table, fresh: bool):
        col = lambda c: table[c].combine_chunks()
        path = col("path")
        self.at = path.offsets.to_numpy() - path.offsets[0].as_py()
        self.len = np.diff(self.at)
        held = path.flatten()
        self.digest = np.frombuffer(b"".join(held.to_pylist()), np.uint64).reshape(-1, 2)
        self.size = col("sizes").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.fresh, self.named = fresh, {}
        if fresh:  # one ending at each path's last depth
            self.sums = {"n": col("n").to_numpy(), "least": col("c").to_numpy()}
            self.ends = col("ends").to_pylist()
        else:
            self.sums = {c: col(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in SUMS}
            self.ends = col("ends").flatten().to_pylist()

    def common(self) -> np.ndarray:
        """Number of first turns that each path shares with the path before it; -1 for the first one."""
        out = np.zeros(len(self.len), np.int64)
        alive, d = np.arange(1, len(self.len)), 0
        while len(alive):
            alive = alive[(self.len[alive] > d) & (self.len[alive - 1] > d)]
            alive = alive[(self.digest[self.at[alive] + d] == self.digest[self.at[alive - 1] + d]).all(1)]
            d += 1
            out[alive] = d
        out[:1] = -1
        return out

    def given(self, d: int, rows: np.ndarray):
        """Sums of these rows at depth ``d``, and the digests of conversations ending there (None: none)."""
        if self.fresh:
            zero = np.zeros(len(rows), np.int64)
            return [self.sums["n"][rows], self.sums["least"][rows], zero, zero, zero], [self.ends[r] for r in rows]
        place = self.at[rows] + rows + d
        return [self.sums[c][place] for c in SUMS], [self.ends[i] for i in place]

    def keys(self, row: int) -> list[bytes]:
        """Name of each node on a row's path, from the root down."""
        if row in self.named:
            return self.named[row]
        h = hashlib.md5()
        out = [h.copy().digest()]
        for x in self.digest[self.at[row] : self.at[row + 1]]:
            h.update(x.tobytes())
            out.append(h.copy().digest())
        self.named[row] = out
        return out

    def peel(self, whole: bool):
        """Finished nodes as tuples of ``NODES``, one list a depth, and at the end the run's fringes."""
        last = len(self.len) - 1
        common, top = self.common(), int(self.len.max())
        order = np.argsort(self.len, kind="stable")
        from_length = np.searchsorted(self.len[order], np.arange(top + 2))
        sides = [] if whole else [0] if last == 0 else [0, last]
        fringes = [{c: [NONE[c]] * (int(self.len[r]) + 1) for c in SUMS} | {"ends": [None] * (int(self.len[r]) + 1)} for r in sides]
        keys = {r: self.keys(r) for r in sides}
        live = np.zeros(0, np.int64)
        up = [np.zeros(0, np.int64) for _ in SUMS]
        pending: list[tuple] = []  # finished nodes one deeper, with the row their parent begins at or before
        for d in range(top, -1, -1):
            mine = np.sort(order[from_length[d] : from_length[d + 1]] if self.fresh else order[from_length[d] :])
            sums, ends = self.given(d, mine)
            rows = np.concatenate([live, mine])
            by = np.argsort(rows, kind="stable")
            rows, values = rows[by], [np.concatenate(x)[by] for x in zip(up, sums)]
            # A row begins a group where it shares fewer than d turns with the path before it; a row may be there twice.
            begins = np.flatnonzero((common[rows] < d) & np.diff(rows, prepend=-1).astype(bool))
            starts = rows[begins]
            n, least, kids, leaves, saved = (np.minimum.reduceat(v, begins) if c == "least" else np.add.reduceat(v, begins) for c, v in zip(SUMS, values))
            group_ends: list[str | None] = [None] * len(starts)
            for r, e in zip(mine, ends):
                if e is not None:
                    group_ends[int(np.searchsorted(starts, r, "right")) - 1] = e
            open_ = np.zeros(len(starts), bool)
            parent_key = {}
            for side, r in enumerate(sides):
                if self.len[r] >= d:
                    g = int(np.searchsorted(starts, r, "right")) - 1
                    parent_key[g] = keys[r][d]
                    if not open_[g]:
                        open_[g] = True
                        for c, v in zip(SUMS, (n, least, kids, leaves, saved)):
                            fringes[side][c][d] = int(v[g])
                        fringes[side]["ends"][d] = group_ends[g]
            out = []
            for row, node in pending:
                g = int(np.searchsorted(starts, row, "right")) - 1
                parent = (None, parent_key[g]) if open_[g] else (int(least[g]), None)
                out.append((node[0], node[1], parent[0], *node[2:], parent[1]))
            if out:
                yield out
            size = self.size[self.at[starts] + d - 1] if d else np.zeros(len(starts), np.int64)
            leaves = np.where(kids == 0, 1, leaves)
            saved = saved + (n - 1) * size
            done = np.flatnonzero(~open_)
            key: list[bytes | None] = [None] * len(starts)
            if not self.fresh:  # runs of the rounds before may refer to it
                key = [self.keys(int(r))[d] for r in starts]
            pending = [(int(starts[g]), (int(least[g]), d, int(n[g]), int(kids[g]), int(leaves[g]), int(saved[g]), group_ends[g] or EMPTY, key[g])) for g in done]
            live = starts
            shut = ~open_
            up = [np.where(shut, v, NONE[c]) for c, v in zip(SUMS, (n, least, np.ones(len(starts), np.int64), leaves, saved))]
        if pending:
            yield [(node[0], node[1], None, *node[2:], None) for _, node in pending]
        self.fringes = [(self.path(r), self.size[self.at[r] : self.at[r + 1]].tolist(), *(f[c] for c in SUMS), f["ends"]) for r, f in zip(sides, fringes)]

    def path(self, row: int) -> list[bytes]:
        return [x.tobytes() for x in self.digest[self.at[row] : self.at[row + 1]]]


_NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary())]
_ROW = [("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())), *[(c, pa.list_(pa.int64())) for c in SUMS], ("ends", pa.list_(pa.string()))]


def _peeled(fresh: bool, whole: bool, run: int, run_turns: int):
    """Sorted rows to nodes and fringes; the runs of a task have at most ``run`` paths and about ``run_turns`` turns. A
    run that is the ``whole`` input has no fringe."""
    schema = pa.schema(_NODE + _ROW)

    def cut(batches):
        held, n, size = [], 0, 0
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                turns = len(part.column(0).flatten())
                if held and not whole and (n + part.num_rows > run or size + turns > run_turns):
                    yield pa.Table.from_batches(held)
                    held, n, size = [], 0, 0
                held.append(part)
                n, size = n + part.num_rows, size + turns
        if held:
            yield pa.Table.from_batches(held)

    def batch(rows, cols, other, first):
        arrays = [pa.array(x, t) for x, (_, t) in zip(zip(*rows), cols)]
        none = [pa.nulls(len(rows), t) for _, t in other]
        return pa.RecordBatch.from_arrays(arrays + none if first else none + arrays, schema=schema)

    def go(batches):
        for table in cut(batches):
            work = Run(table, fresh)
            out = []
            for nodes in work.peel(whole):
                out += nodes
                while len(out) >= 20_000:
                    yield batch(out[:20_000], _NODE, _ROW, True)
                    out = out[20_000:]
            if out:
                yield batch(out, _NODE, _ROW, True)
            if work.fringes:
                yield batch(work.fringes, _ROW, _NODE, False)

    return go


def trie(distinct: DataFrame, run: int = RUN, run_turns: int = RUN_TURNS, last: int = LAST) -> DataFrame:
    """Nodes of the trie of ``distinct`` sequences (of :func:`paths`), the parents by key where a run did not know them."""
    spark: SparkSession = distinct.sparkSession
    rows, fresh, found, before = stored(distinct, "sequences"), True, [], None
    while True:
        count = rows.count()
        if not count:
            break
        # Runs of many rows shrink to two; should a round not shrink, its runs were of one or two, and few.
        whole = count <= last or before is not None and count >= before
        before = count if not fresh else None
        lead = F.slice("path", 1, 64)
        places = partitions(spark, count, run) if fresh else max(1, min(-(-count // run), count // 4))
        dealt = rows.repartition(1) if whole else rows.repartitionByRange(places, lead)
        names = [n for n, _ in _ROW] if not fresh else ["path", "sizes", "c", "n", "ends"]
        out = dealt.select(*names).sortWithinPartitions("path").mapInArrow(_peeled(fresh, whole, run, run_turns), f"{NODES}, {ROWS}")
        out = stored(out, "peeled")
        found.append(out.where("conv_id is not null").select(*[n for n, _ in _NODE]))
        if whole:
            break
        rows, fresh = out.where("path is not null").select(*[n for n, _ in _ROW]), False
    if not found:
        return spark.createDataFrame([], NODES).drop("key", "parent_key")
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    cols = [n for n, _ in _NODE if n not in ("key", "parent_key")]
    shared = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    root = nodes.where("depth = 0").agg(F.min("conv_id")).first()[0]
    # The root is every first turn's parent; it is one number, so these rows need no join.
    top = nodes.where("parent_key is not null and depth = 1").withColumn("parent_conv_id", F.lit(root).cast("long"))
    deep = nodes.where("parent_key is not null and depth > 1").join(shared, "parent_key").withColumn("parent_conv_id", F.col("above"))
    return nodes.where("parent_key is null").select(*cols).unionByName(top.select(*cols)).unionByName(deep.select(*cols))


def prefix_trie(conversations: DataFrame, width: int = 5, heads: int = HEAD, run: int = RUN, run_turns: int = RUN_TURNS, last: int = LAST) -> DataFrame:
    """Nodes of the rebuilt conversations (:func:`family`) of ``conversations(conv_id, turn, role, text, ...)``: conv_id
    (least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role and text are empty; a null turn comes first; equal turns are ordered by a digest of role and text, and rows
    that repeat are turns of their own. Rows with a null conv_id are no conversation. A remainder of a negative id is
    negative, as in SQL. Without a conversation there is no node, not even a root. Other columns are not read.
    """
    return trie(paths(family(turns(conversations), width, heads)), run, run_turns, last)
