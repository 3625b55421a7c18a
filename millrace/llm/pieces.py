"""N-best segmentation over the piece lattice, and decoding.

A text is normalised by the model file's own rules. Its lattice has an edge for every vocabulary piece at every place,
and for a character without a piece of its own an edge that stands for its byte pieces (or the unknown id). Scores are
whole millionths, so sums are exact in any order. Forward Viterbi gives every place its best score from the left; these
are exact heuristics for a backward A* search from the end, whose first ``n`` completions are the ``n`` best.

No piece reaches over the start of a run of word marks or over a character that only stands alone, so the lattice falls
apart there into units (words); the best of the whole is the sum over units, and the n best differ from the best only in
the n - 1 units with the least loss. Viterbi runs over all new units of a batch at once, by length, with the loss of
each unit's second best; A* opens only those units whose loss can reach the n best. This is the same search as over the
whole lattice, without walking equal words again.

A unigram file's scores are used as they stand. A BPE file holds merge ranks, not scores; its pieces get Zipf scores
-log(rank + 2) - log(sum). Ties: the longest last piece wins in Viterbi; equal n-best scores come in the order of the
search, changed units from the left first. Null and empty texts have no units: one empty segmentation of score 0.

Each of a text's n best paths is put together whole and decoded from its ids; the decoded text and the round trip come
from that, not from what is known of the text's units.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import defaultdict
from dataclasses import dataclass
from functools import partial
from itertools import chain, count, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, arrow_map, fields, kept

MARK = "▁"
MILLION = 1_000_000
UNKNOWN_PENALTY = 10 * MILLION
NEVER = -(1 << 60)
LONG = 64
#: Bytes of the UTF-8 character that starts with each byte; 0 inside a character.
CHAR = [1] * 0x80 + [0] * 0x40 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10
REMEMBERED = 150_000


@dataclass(frozen=True)
class Segmentation:
    """One path: ids and score in millionths."""

    ids: tuple[int, ...]
    score: int


def contents(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of a large binary column without nulls, and where its values begin and the last ends."""
    _, places, data = column.buffers()
    return memoryview(data or b""), np.frombuffer(places, np.int64, len(column) + 1, 8 * column.offset)


class Lattice:
    """The vocabulary of a model file as lattice edges."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m, size = self.model, self.model.get_piece_size()
        self.surface: list[bytes] = [b""] * size
        self.bytes: dict[int, int] = {}
        self.unknown = m.unk_id()
        self.first_mark = m.normalize("a").startswith(MARK)
        normal = []
        for i in range(size):
            if m.is_byte(i):
                self.bytes[int(m.id_to_piece(i)[1:-1], 16)] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                normal.append(i)
                self.surface[i] = m.id_to_piece(i).encode()
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        given = [m.get_score(i) for i in normal]
        if given and all(s == int(s) for s in given):
            weight = 1 / (np.argsort(np.argsort([-s for s in given], kind="stable"), kind="stable") + 2.0)
            given = np.log(weight / weight.sum()).tolist()
        self.pieces = pa.array(self.surface, pa.large_binary())
        self.edge = {self.surface[i]: (i, round(s * MILLION)) for i, s in zip(normal, given) if self.surface[i]}
        self.longest = max(map(len, self.edge), default=1)
        self.missing = min((s for _, s in self.edge.values()), default=0) - UNKNOWN_PENALTY
        texts = [p.decode() for p in self.edge]
        inner = [t for t in texts if MARK in t.lstrip(MARK)]
        alone = "".join(c for c in "\n\t\r" if not any(c in t and len(t) > 1 for t in texts))
        cut = rf"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "")
        self.unit = re.compile(cut) if not inner else re.compile(r"(?s).+")
        self._table()
        self.known: dict[str, tuple[bytes, int, int]] = {}
        self.several: dict[tuple[str, int], list[Segmentation]] = {}
        self.older: dict[str, tuple[bytes, int, int]] = {}
        self.sizes = np.array([len(x) for x in self.surface], np.int64)
        self.broken: set[str] = set()  # units of which a path does not decode to the unit

    def _table(self) -> None:
        """Pieces by a 64-bit rolling hash in a direct table; pieces that share a slot are chained."""
        self.power = np.cumprod(np.full(self.longest + 2, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
        self.power = np.concatenate([[np.uint64(1)], self.power])
        keys = np.array([self._hash(p) for p in self.edge], np.uint64)
        self.edge_id = np.array([i for i, _ in self.edge.values()], np.int32)
        #: By edge number; the last two are a character without a piece (-2) and no edge (-1).
        self.edge_by_number = np.concatenate([[s for _, s in self.edge.values()], [self.missing, NEVER]]).astype(np.int64)
        self.keys = np.append(keys, np.uint64(0))  # the last is looked at where a chain ends
        self.slots, self.chained = np.full(1 << 20, -1, np.int32), np.full(len(self.keys), -1, np.int32)
        for number, slot in enumerate((keys * self.ODD >> np.uint64(44)).tolist()):
            self.chained[number], self.slots[slot] = self.slots[slot], number

    ODD = np.uint64(0xD6E8FEB86659FD93)

    def _hash(self, piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * 0x9E3779B97F4A7C15 + b + 1) & (1 << 64) - 1
        return h

    def _find(self, hashed: np.ndarray) -> np.ndarray:
        """Edge number of each hash, or -1."""
        number = self.slots[hashed * self.ODD >> np.uint64(44)]
        flat, wanted = number.reshape(-1), hashed.reshape(-1)
        at = np.flatnonzero(flat >= 0)
        at = at[self.keys[flat[at]] != wanted[at]]
        while len(at):
            flat[at] = self.chained[flat[at]]
            at = at[(flat[at] >= 0) & (self.keys[flat[at]] != wanted[at])]
        return number

    def _together(self, units: list[bytes]) -> list[tuple[bytes, int, int]]:
        """Best ids, score and loss of the second best (-1: none) of units of one length, at once. Arrays run over
        places first, units second."""
        n, size = len(units), len(units[0])
        text = np.ascontiguousarray(np.frombuffer(b"".join(units), np.uint8).reshape(n, size).T)
        rolled = np.zeros((size + 1, n), np.uint64)
        for j in range(size):
            rolled[j + 1] = rolled[j] * self.power[1] + text[j] + np.uint64(1)
        char = np.array(CHAR, np.int8)[text]
        begins = np.append((char > 0).any(axis=1), True)  # places that are inside a character in every unit have no edges
        edges, scores = {}, {}
        for l in range(1, min(size, max(self.longest, 4)) + 1):
            at = size - l + 1
            found, rows = np.full((at, n), -1, np.int32), np.flatnonzero(begins[:at] & begins[l:])
            if l <= self.longest:
                found[rows] = self._find(rolled[rows + l] - rolled[rows] * self.power[l])
            if l <= 4:
                found[(char[:at] == l) & (found < 0)] = -2
            if (found != -1).any():
                edges[l] = found
                scores[l] = self.edge_by_number[found]
        left = np.full((size + 1, n), 2 * NEVER, np.int64)
        left[0] = 0
        back = np.zeros((size + 1, n), np.int8)
        for j in range(1, size + 1):
            for l, score in scores.items():
                if l <= j:
                    s = left[j - l] + score[j - l]
                    np.copyto(back[j], l, where=(s >= left[j]) & (s > NEVER))
                    np.maximum(left[j], s, out=left[j])
        right = np.full((size + 1, n), 2 * NEVER, np.int64)
        right[size] = 0
        for i in range(size - 1, -1, -1):
            for l, score in scores.items():
                if i + l <= size:
                    np.maximum(right[i], right[i + l] + score[i], out=right[i])
        total = left[size]
        through = {l: left[: size - l + 1] + score + right[l:] for l, score in scores.items()}
        row, at, steps = np.arange(n), np.full(n, size), []
        while len(row):
            step = back[at, row]
            at = at - step
            for l in through:
                mine = step == l
                if mine.any():
                    r, a = row[mine], at[mine]
                    steps.append((r, a, edges[l][a, r]))
                    through[l][a, r] = 2 * NEVER
            row, at = row[at > 0], at[at > 0]
        second = np.max([t.max(axis=0) for t in through.values()], axis=0)
        loss = np.where(second > NEVER, total - second, -1).tolist()
        row, at, number = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((at, row))
        row, at, number = row[order], at[order], number[order]
        ends = np.searchsorted(row, np.arange(n), "right")
        data, stops = self.edge_id[number].astype("<i4").tobytes(), (4 * ends).tolist()
        out = [data[a:b] for a, b in zip([0, *stops], stops)]
        for r in np.unique(row[number == -2]).tolist():
            ids: list[int] = []
            for k in range(ends[r - 1] if r else 0, ends[r]):
                ids += [int(self.edge_id[number[k]])] if number[k] >= 0 else self._bare(units[r], int(at[k]))
            out[r] = np.array(ids, "<i4").tobytes()
        return list(zip(out, total.tolist(), loss))

    def _bare(self, text: bytes, at: int) -> list[int]:
        """Ids of the character at a place that has no piece of its own."""
        size = CHAR[text[at]]
        return [self.bytes[b] for b in text[at : at + size]] if len(self.bytes) == 256 else [self.unknown]

    def _edges_into(self, text: bytes, j: int):
        """Edges that end at ``j``: (start, ids, score)."""
        for l in range(1, min(j, self.longest) + 1):
            hit = self.edge.get(text[j - l : j])
            if hit:
                yield j - l, [hit[0]], hit[1]
        for l in range(1, min(j, 4) + 1):
            if CHAR[text[j - l]]:
                if CHAR[text[j - l]] == l and text[j - l : j] not in self.edge:
                    yield j - l, self._bare(text, j - l), self.missing
                break

    def nbest(self, unit: bytes, n: int) -> list[Segmentation]:
        """The ``n`` best segmentations of one unit: forward Viterbi, then backward A*."""
        size = len(unit)
        into = [[] for _ in range(size + 1)]
        best = [0] + [2 * NEVER] * size
        for j in range(1, size + 1):
            for e in self._edges_into(unit, j):
                if best[e[0]] > NEVER:
                    into[j].append(e)
                    best[j] = max(best[j], best[e[0]] + e[2])
        order, out = count(0, -1), []
        heap = [(-best[size], 0, size, 0, None)]
        while heap and len(out) < n:
            _, _, at, tail, chain = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while chain is not None:
                    ids += chain[0]
                    chain = chain[1]
                out.append(Segmentation(tuple(ids), tail))
                continue
            for start, ids, score in into[at]:
                heapq.heappush(heap, (-(best[start] + tail + score), next(order), start, tail + score, (ids, chain)))
        return out

    def units(self, text: str) -> list[str]:
        return self.unit.findall(self.model.normalize(text)) if text else []

    def cut(self, text: str) -> tuple[list[str], bool]:
        """The units of a text, and whether they are the whole normalised text."""
        if not text:
            return [], True
        normal = self.model.normalize(text)
        units = self.unit.findall(normal)
        return units, "".join(units) == normal

    def viterbi(self, unit: bytes) -> Segmentation:
        """The best path of one unit; of equal ones that with the longest last piece, as in :meth:`_together`."""
        best, back = [0] + [2 * NEVER] * len(unit), [(0, [])] * (len(unit) + 1)
        for j in range(1, len(unit) + 1):
            for start, ids, score in sorted(self._edges_into(unit, j), key=lambda e: -e[0]):
                if best[start] > NEVER and best[start] + score >= best[j]:
                    best[j], back[j] = best[start] + score, (start, ids)
        parts, at = [], len(unit)
        while at:
            at, ids = back[at][0], back[at][1]
            parts.append(ids)
        return Segmentation(tuple(i for p in reversed(parts) for i in p), best[-1])

    def learn(self, units) -> None:
        """Best path, score and second-best loss of every unit not seen yet. Each is decoded once, to tell which units are
        broken. When ``REMEMBERED`` units are known, those not met again before as many others are forgotten."""
        if len(self.known) > REMEMBERED:
            self.older, self.known, self.several = self.known, {}, {}
        fresh = []
        for u in set(units).difference(self.known):
            if u in self.older:
                self.known[u] = self.older[u]
            else:
                fresh.append(u)
        self._learn(fresh)
        if not self._sound(fresh):
            self.broken.update(u for u in fresh if not self._sound([u]))

    def _sound(self, units: list[str]) -> bool:
        """Whether the best paths of these units decode to them: their pieces have each unit's length and together its
        bytes."""
        if not units:
            return True
        data, texts = [self.known[u][0] for u in units], [u.encode() for u in units]
        ids = np.frombuffer(b"".join(data), "<i4")
        count = np.fromiter(map(len, data), np.int64, len(data)) // 4
        if not count.all():
            return False
        size = np.add.reduceat(self.sizes[ids], np.cumsum(count) - count)
        return bool((size == np.fromiter(map(len, texts), np.int64, len(texts))).all()) and self.decode(ids.tolist()) == b"".join(texts)

    def _learn(self, units) -> None:
        units = [u for u in units if u not in self.known]
        texts = [u.encode() for u in units]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(sizes, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if units else ():
            if sizes[group[0]] > LONG:
                for k in group.tolist():
                    first, two = self.viterbi(texts[k]), self.nbest(texts[k], 2)
                    self.known[units[k]] = (np.array(first.ids, "<i4").tobytes(), first.score, two[0].score - two[1].score if len(two) > 1 else -1)
                continue
            for at in range(0, len(group), 4096):
                part = group[at : at + 4096].tolist()
                self.known.update(zip([units[k] for k in part], self._together([texts[k] for k in part])))

    def best(self, units: list[str], n: int) -> tuple[bytes, list[int], list[dict[int, Segmentation]]]:
        """Of a text's units: the best ids (little-endian 32 bits), the n best scores, and for each of the n best the
        units whose segmentation differs from the best."""
        got = list(map(self.known.__getitem__, units))
        own, each, losses = zip(*got) if got else ((), (), ())
        ranked = self._ranked(units, np.fromiter(losses, np.int64, len(losses)), n)
        return b"".join(own), [sum(each) - loss for loss, _ in ranked], [change for _, change in ranked]

    def _ranked(self, units: list[str], gap: np.ndarray, n: int) -> list[tuple[int, dict[int, Segmentation]]]:
        """Of a text's units and the losses of their second best: what each of the n best loses, and where it differs."""
        ranked: list[tuple[int, tuple[tuple[int, int], ...]]] = [(0, ())]
        if n > 1 and len(gap):
            able = np.flatnonzero(gap >= 0)
            if len(able) > n - 1:
                limit = np.partition(gap[able], n - 2)[n - 2]
                able = np.concatenate([able[gap[able] < limit], able[gap[able] == limit]])[: n - 1]
            for at in sorted(able.tolist()):
                options = self._options(units[at], n)
                ranked = sorted(
                    (loss + options[0].score - o.score, change + (((at, k),) if k else ()))
                    for loss, change in ranked for k, o in enumerate(options)
                )[:n]
        return [(loss, {at: self._options(units[at], n)[k] for at, k in change}) for loss, change in ranked]

    def paths(self, texts: list[list[str]], n: int) -> tuple[list[list[int]], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Of many texts' units: each text's n best scores, and the n best whole paths, best first: the ids of one after
        another, where each text's end, and the texts that have so many paths. Learns the units it has not met."""
        number: defaultdict[str, int] = defaultdict(count().__next__)
        total = sum(map(len, texts))
        code = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, total)
        self.learn(number)
        data, scores, losses = zip(*map(self.known.__getitem__, number)) if number else ((), (), ())
        own = pa.array(data, pa.large_binary()).take(pa.array(code))
        ids, at = contents(own)
        first = np.cumsum([0, *map(len, texts)])
        sums = np.concatenate([[0], np.cumsum(np.array(scores, np.int64)[code])])[first].tolist()
        gap, ends, begins = np.array(losses, np.int64)[code], at[first].tolist(), first.tolist()
        each: list[list[int]] = []
        parts: list[list[bytes]] = [[] for _ in range(max(n, 1))]
        sizes: list[list[int]] = [[] for _ in parts]
        held: list[list[int]] = [[] for _ in parts]
        for k, units in enumerate(texts):
            ranked = self._ranked(units, gap[begins[k] : begins[k + 1]], n)
            each.append([sums[k + 1] - sums[k] - loss for loss, _ in ranked])
            for rank, (_, change) in enumerate(ranked):
                done, size = ends[k], ends[k + 1] - ends[k]
                for place, other in sorted(change.items()):
                    here, there = at[begins[k] + place : begins[k] + place + 2].tolist()
                    new = np.array(other.ids, "<i4").tobytes()
                    parts[rank] += [ids[done:here], new]
                    size += len(new) - (there - here)
                    done = there
                parts[rank].append(ids[done : ends[k + 1]])
                sizes[rank].append(size // 4)
                held[rank].append(k)
        return each, [(np.frombuffer(b"".join(p), "<i4"), np.cumsum(s, dtype=np.int64), np.array(h, np.int64)) for p, s, h in zip(parts, sizes, held)]

    def _options(self, unit: str, n: int) -> list[Segmentation]:
        """The n best of a unit, with Viterbi's own path first."""
        found = self.several.get((unit, n))
        if found is None:
            first = tuple(np.frombuffer(self.known[unit][0], "<i4").tolist())
            found = self.nbest(unit.encode(), n)
            own = [s for s in found if s.ids == first] or [Segmentation(first, self.known[unit][1])]
            found = self.several[unit, n] = (own + [s for s in found if s.ids != first])[:n]
            if any(self.decode(s.ids) != unit.encode() for s in found):
                self.broken.add(unit)
        return found

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The normalised texts of many paths' ids, one after another, that end at ``ends``: as :meth:`decode` of each."""
        data, at = contents(self.pieces.take(pa.array(ids)))
        stops = at[ends].tolist()
        return [bytes(data[a:b]) for a, b in zip([0, *stops], stops)]

    def decode(self, ids) -> bytes:
        """The normalised text of ids, word marks included; control ids have no text."""
        return b"".join(map(self.surface.__getitem__, ids))

    def plain(self, ids) -> str:
        """The text of ids: marks become spaces, the mark that normalisation puts first goes."""
        return self.spaced(self.decode(ids).decode("utf-8", "replace"))

    def spaced(self, decoded: str) -> str:
        """Decoded pieces as text."""
        text = decoded.replace(MARK, " ")
        return text[1:] if self.first_mark and text.startswith(" ") else text


def segment(docs: DataFrame, model: str, n: int = 4, text: str = "text", ids: bool = True, decoded: bool = True, hide: tuple[str, ...] = (), at_once: int = SLICE) -> DataFrame:
    """Add n_pieces, score (log probability of the best), nbest_scores, nbest_pieces (counts), ids_crc32 (best ids as
    little-endian unsigned 32-bit integers), round_trip (the ids of each of the n best decode to the normalised text) and,
    with ``ids`` and ``decoded``, the best ids and the text that is decoded from them. Columns of these names are
    replaced. ``at_once`` rows are cut, looked up and decoded together: fewer take less memory and more time."""
    at = docs.columns.index(text)
    more = {k: t for k, t, wanted in (("ids", "array<int>", ids), ("decoded", "string", decoded)) if wanted}
    added = fields(n_pieces="long", score="double", nbest_scores="array<double>", nbest_pieces="array<bigint>", ids_crc32="long", round_trip="boolean", **more)

    def run(batches):
        lattice = kept(("lattice", model), partial(Lattice, model))
        for b in batches:
            normal = [lattice.model.normalize(t) if t else "" for t in b.column(at).to_pylist()]
            scores, paths = lattice.paths([lattice.unit.findall(t) for t in normal], n)
            wanted = [t.encode() for t in normal]
            same, counts, plain = [True] * len(normal), [[] for _ in normal], []
            for rank, (path, ends, rows) in enumerate(paths):
                found = lattice.decode_all(path, ends)
                for k, size, text_of_path in zip(rows.tolist(), np.diff(ends, prepend=0).tolist(), found):
                    counts[k].append(size)
                    same[k] = same[k] and text_of_path == wanted[k]
                if decoded and rank == 0:
                    plain = [lattice.spaced(x.decode("utf-8", "replace")) for x in found]
            best, ends = paths[0][0], np.concatenate([[0], paths[0][1]])
            out = [
                pa.array([c[0] for c in counts], pa.int64()),
                pa.array([s[0] / MILLION for s in scores], pa.float64()),
                pa.array([[x / MILLION for x in s] for s in scores], pa.list_(pa.float64())),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array([zlib.crc32(best[a:b]) for a, b in pairwise(ends.tolist())], pa.int64()),
                pa.array(same, pa.bool_()),
            ]
            if ids:
                out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(best)))
            if decoded:
                out.append(pa.array(plain, pa.string()))
            yield out

    return arrow_map(docs.withColumn(text, F.col(text).cast("string")), run, added, hide, ("lattice", model), at_once)
