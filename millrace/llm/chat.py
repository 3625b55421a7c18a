"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the assistant. Each given
turn is kept, merged into the turn before it, or relabelled (then placed or merged); empty turns may be inserted. The
cheapest legal sequence is found by dynamic programming over the automaton's states: start, system, user, assistant.
Costs: ``MERGE``, ``RELABEL``, ``INSERT``; a role that is none of the three must be relabelled. Of equally cheap repairs
the one with fewer relabels, then fewer insertions is taken, then the one whose last differing state comes first
(border states of segments are settled before those inside).

All rows are sorted by conversation and turn in ranges of about equal size, and a conversation is cut into segments of at
most ``SEGMENT`` rows, whatever their turn numbers. The cost of a segment for each entry and exit state is a
small matrix; matrices of long conversations are chained (minimum over sums) to find the states at their borders, and
every segment is then repaired on its own. So a conversation with very many turns is spread over tasks.

Order: turn (null first), then a hash of role and text, so repeated turn numbers and repeated rows have a defined order.
Null texts are empty; rows with a null conversation id form one conversation. Roles are compared without case and outer
blanks. Markers inside texts are broken up by a space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored

MERGE, RELABEL, INSERT = 1, 3, 2
SEGMENT, RANGE = 1024, 100_000
ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: A cost with its tie-breaks: relabels, then insertions.
UNIT, RELABELS, INSERTS = 1 << 40, 1 << 20, 1
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
FAR = 1 << 62


def moves(role: int) -> list[tuple[int, int, int, int, bool]]:
    """Ways to take a turn of ``role`` (1 to 3, or 0 for none of the roles): (from, to, cost, inserted role or 0, merged)."""
    out = []
    for p in range(4):
        for q in (SYSTEM, USER, ASSISTANT):
            change = 0 if q == role else RELABEL * UNIT + RELABELS
            if p == q:
                out.append((p, q, MERGE * UNIT + change, 0, True))
            if q in NEXT[p]:
                out.append((p, q, change, 0, False))
            for x in NEXT[p]:
                if q in NEXT[x]:
                    out.append((p, q, INSERT * UNIT + INSERTS + change, x, False))
    return out


MOVES = [sorted(moves(r), key=lambda m: (m[2], m[0], m[1])) for r in range(4)]
#: Empty turns that end a conversation in each state, with their cost.
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def end_cost(state: int) -> int:
    return len(ENDING[state]) * (INSERT * UNIT + INSERTS)


def step_matrix(role: int) -> np.ndarray:
    m = np.full((4, 4), FAR, np.int64)
    for p, q, c, _, _ in MOVES[role]:
        m[p, q] = min(m[p, q], c)
    return m


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheapest cost through both: minimum over the state between."""
    return np.minimum(FAR, (np.minimum(a, FAR // 2)[:, :, None] + np.minimum(b, FAR // 2)[None, :, :]).min(axis=1))


def repair(roles: list[int], entry: int, exit: int | None) -> tuple[int, list[tuple[int, int, int, int, bool]]]:
    """Cheapest moves for the roles from ``entry`` to ``exit`` (None: to the end of the conversation)."""
    best = [FAR] * 4
    best[entry] = 0
    back = []
    for r in roles:
        now, by = [FAR] * 4, [None] * 4
        for m in MOVES[r]:
            c = best[m[0]] + m[2]
            if c < now[m[1]] or c == now[m[1]] and by[m[1]] is not None and m[0] < by[m[1]][0]:
                now[m[1]], by[m[1]] = c, m
        back.append(by)
        best = now
    if exit is None:
        exit = min(range(4), key=lambda s: (best[s] + end_cost(s), s))
        total = best[exit] + end_cost(exit)
    else:
        total = best[exit]
    path, at = [], exit
    for by in reversed(back):
        path.append(by[at])
        at = by[at][0]
    return total, path[::-1]


def _role_number(role: str | None) -> int:
    role = (role or "").strip().lower()
    return ROLES.index(role) + 1 if role in ROLES else 0


def _safe(text: str | None) -> str:
    return (text or "").replace("<|im_", "<| im_")


def _runs(batches, keys: int):
    """Rows of sorted batches, as tuples, grouped by their first ``keys`` columns."""
    held, now = [], None
    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns))):
            if held and row[:keys] != now:
                yield now, held
                held = []
            now = row[:keys]
            held.append(row)
    if held:
        yield now, held


def _matrices(batches):
    steps = [step_matrix(r) for r in range(4)]
    out = []
    for (conv, seg), rows in _runs(batches, 2):
        m = steps[_role_number(rows[0][2])]
        for r in rows[1:]:
            m = chain(m, steps[_role_number(r[2])])
        out.append((conv, seg, m.ravel().tolist()))
        if len(out) >= 1000:
            yield _packed(out)
            out = []
    if out:
        yield _packed(out)


def _packed(out):
    c, s, m = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(s, pa.int64()), pa.array(m, pa.list_(pa.int64()))], names=["c", "seg", "m"])


def _borders(batches):
    """Segments of one conversation after the other, in order, to their entry and exit states. Only one small number per
    segment and state is held."""
    now, best, back, segs = None, None, bytearray(), []

    def finish():
        at = min(range(4), key=lambda s: (int(best[s]) + end_cost(s), s))
        states = [at]
        for k in range(len(segs) - 1, -1, -1):
            at = back[4 * k + at]
            states.append(at)
        states.reverse()
        n = len(segs)
        return pa.RecordBatch.from_arrays(
            [pa.array([now] * n, pa.int64()), pa.array(segs, pa.int64()), pa.array(range(n), pa.int64()), pa.array(states[:-1], pa.int32()),
             pa.array([None if k == n - 1 else s for k, s in enumerate(states[1:])], pa.int32())],
            names=["c", "seg", "place", "entry", "leave"],
        )

    for b in batches:
        for conv, seg, m in zip(*(b.column(k).to_pylist() for k in range(3))):
            if best is not None and conv != now:
                yield finish()
                best = None
            if best is None:
                now, best, back, segs = conv, np.array([0, FAR, FAR, FAR]), bytearray(), []
            through = np.minimum(best, FAR // 2)[:, None] + np.minimum(np.array(m, np.int64).reshape(4, 4), FAR // 2)
            back += bytes(through.argmin(axis=0).astype(np.uint8).tolist())
            best = np.minimum(FAR, through.min(axis=0))
            segs.append(seg)
    if best is not None:
        yield finish()


ACTIONS = {(False, False): "keep", (False, True): "merge", (True, False): "relabel", (True, True): "relabel and merge"}


def _rendered(batches):
    out = []
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["conv_id", "segment", "piece", "turn", "role", "action", "cost", "rendered"]

    def opened(state, role):
        return ("" if state == START else CLOSE + "\n") + OPEN + ROLES[role - 1] + "\n"

    for (conv, seg), rows in _runs(batches, 2):
        roles = [_role_number(r[2]) for r in rows]
        entry, leave, last = rows[0][5] or START, rows[0][6], rows[0][6] is None
        _, path = repair(roles, entry, leave)
        piece, seg = 0, rows[0][7]
        for r, role, (p, q, cost, inserted, merged) in zip(rows, roles, path):
            if inserted:
                out.append([conv, seg, piece, None, ROLES[inserted - 1], "insert", INSERT, opened(p, inserted)])
                piece, p = piece + 1, inserted
            start = "\n\n" if merged else opened(p, q)
            own = cost // UNIT - (INSERT if inserted else 0)
            out.append([conv, seg, piece, r[3], ROLES[q - 1], ACTIONS[q != role, merged], own, start + _safe(r[4])])
            piece += 1
        if last:
            at = path[-1][1]
            for x in ENDING[at]:
                out.append([conv, seg, piece, None, ROLES[x - 1], "insert", INSERT, opened(at, x)])
                piece, at = piece + 1, x
            out[-1][7] += CLOSE + "\n"
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def format_chat(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Pieces of the repaired conversations: conv_id, segment (from 0), piece (order in the segment), turn (null if
    inserted), role, action, cost, rendered. A conversation's text is its pieces' ``rendered`` in order of segment and
    piece, its repair cost the sum of ``cost``. Columns of ``turns`` beside conv_id, turn, role and text are not read,
    whatever their names."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).withColumn("h", F.xxhash64("role", "text"))
    # Ranges of rows, not of turn numbers: rows that are equal in all of these may be cut apart by the last one.
    keys = [F.col("c").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("h"), F.col("mix")]
    dealt = rows.withColumn("mix", F.rand(3)).repartitionByRange(partitions(turns.sparkSession, rows.count(), RANGE), *keys)
    placed = dealt.sortWithinPartitions(*keys).drop("mix", "h").withColumn("row", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("seg", F.floor(F.col("row") / segment).cast("long")), "turns")
    per = placed.groupBy("c", "seg").agg(F.count("*").alias("n"))
    long = per.groupBy("c").agg(F.count("*").alias("segs")).where("segs > 1").select(F.col("c").alias("lc"))
    some = placed.join(long, F.col("c").eqNullSafe(F.col("lc")), "left_semi")
    dealt = some.select("c", "seg", "role", "row").repartition("c", "seg").sortWithinPartitions("c", "seg", "row")
    matrices = dealt.mapInArrow(_matrices, "c long, seg long, m array<long>")
    ordered = matrices.repartition("c").sortWithinPartitions("c", "seg")
    borders = stored(ordered.mapInArrow(_borders, "c long, seg long, place long, entry int, leave int"), "borders")
    borders = borders.select(F.col("c").alias("bc"), F.col("seg").alias("bs"), "place", "entry", "leave")
    joined = placed.join(borders, F.col("c").eqNullSafe(F.col("bc")) & (F.col("seg") == F.col("bs")), "left")
    place = F.coalesce("place", F.lit(0).cast("long")).alias("place")
    final = joined.select("c", "seg", "role", "turn", "text", "entry", "leave", place, "row")
    final = final.repartition("c", "seg").sortWithinPartitions("c", "seg", "row")
    return final.mapInArrow(
        _rendered, "conv_id long, segment long, piece long, turn long, role string, action string, cost long, rendered string"
    )
