"""Benchmark decontamination: every passage of every document queries a BM25 index of the benchmark's items.

Items are cut into parts of at most ``PART`` words; the parts are the indexed documents. A passage is a window of
``PASSAGE`` words, one every ``STRIDE``; its distinct words are the query. Impacts are BM25 weights divided by the part's
own score, so a passage that holds a whole part scores about 1 whatever the part's length, and one threshold suits all.

Retrieval is block-max WAND with blocks of part numbers: each word has its largest impact overall and per block. Words
of many blocks add their overall maximum to every block's bound, the others their block maxima; a block whose bound
stays under the threshold is skipped, and only the blocks that are left are scored part by part. Bounds and scores of
all passages of a batch are worked out at once; no part at or above the threshold is missed.

A retrieved item is verified in the words around the passage: the share of its question's three-word runs found there,
and the share of its answer's. The answer is the last sentence that has words; in an item of one sentence, its last
quarter. A leak needs both. The benchmark is indexed in blocks of at most ``BLOCK_CHARS`` characters, each shipped to
the tasks; statistics are over all items.

Null and empty texts have no passage; null or wordless items are not indexed; an empty benchmark finds nothing. Repeated
rows of documents each get their matches; repeated item ids count as one item, matched by any of its rows.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fields, raw

PASSAGE, STRIDE, PART = 64, 32, 48
THRESHOLD, QUESTION, ANSWER = 0.5, 0.6, 0.6
K1, B = 1.2, 0.75
BLOCK_PARTS = 16
BLOCK_CHARS = 8 << 20
#: Passages times blocks that are bounded at once.
CELLS = 1 << 21

#: A-Z to a-z; every other ASCII byte that is no digit or letter to a space.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() and b < 0x80 else 0x20 for b in range(256)).lower()


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def answer_at(text: bytes) -> int:
    """The word number at which an item's answer starts."""
    sentences = [len(words(s)) for s in re.split(rb"(?<=[.!?])\s+|\n", text)]
    sentences = [n for n in sentences if n]
    total = sum(sentences)
    return total - sentences[-1] if len(sentences) > 1 else total - max(1, total // 4)


def expand(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For CSR ranges: the row each element belongs to, and its place."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


class Index:
    """BM25 impacts of parts with block maxima, and the items' three-word runs."""

    def __init__(self, items: list[tuple[int, bytes]], frequency: dict[bytes, int], total: int, mean: float):
        self.items = [(i, words(t), answer_at(t)) for i, t in items]
        self.ids = {w: k for k, w in enumerate(sorted({w for _, ws, _ in self.items for w in ws}), 1)}
        v = len(self.ids) + 1
        term, part, impact, self.item_of = [], [], [], []
        for n, (_, ws, _) in enumerate(self.items):
            pieces = -(-len(ws) // PART)
            for k in range(pieces):
                own = ws[k * len(ws) // pieces : (k + 1) * len(ws) // pieces]
                counts: dict[bytes, int] = {}
                for w in own:
                    counts[w] = counts.get(w, 0) + 1
                norm = K1 * (1 - B + B * len(own) / mean)
                weight = {w: np.log1p((total - frequency[w] + 0.5) / (frequency[w] + 0.5)) * c * (K1 + 1) / (c + norm) for w, c in counts.items()}
                whole = sum(weight.values())
                for w, x in weight.items():
                    term.append(self.ids[w])
                    part.append(len(self.item_of))
                    impact.append(x / whole)
                self.item_of.append(n)
        order = np.lexsort((part, term))
        self.term, self.part, self.impact = (np.array(x)[order] for x in (term, part, impact))
        self.blocks = -(-len(self.item_of) // BLOCK_PARTS)
        key = self.term * self.blocks + self.part // BLOCK_PARTS
        self.block_key, at = np.unique(key, return_index=True)
        self.block_max = np.maximum.reduceat(self.impact, at)
        self.posting_at, self.posting_n = at, np.diff(np.append(at, len(key)))
        block_term, self.block_of = self.block_key // self.blocks, self.block_key % self.blocks
        self.block_at = np.searchsorted(block_term, np.arange(v))
        self.block_n = np.searchsorted(block_term, np.arange(v), "right") - self.block_at
        self.top = np.zeros(v)
        np.maximum.at(self.top, self.term, self.impact)
        self.wide = self.block_n > max(1, self.blocks // 4)
        self.runs = [self._runs(np.array([self.ids[w] for w in ws]), cut) for _, ws, cut in self.items]

    def _runs(self, seq: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray, int]:
        n = min(3, len(seq))
        keys = run_keys(seq, n, len(self.ids) + 1)
        ends = np.arange(n - 1, len(seq))
        question, answer = keys[ends < cut], keys[ends >= cut]
        return question, answer, n

    def retrieve(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Given distinct (passage, term) pairs, sorted: (passage, part, score) of every part that reaches the threshold."""
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        count = int(passage[-1]) + 1 if len(passage) else 0
        each = max(1, CELLS // self.blocks)
        for lo in range(0, count, each):
            a, b = np.searchsorted(passage, [lo, lo + each])
            if b > a:
                p, part, score = self._retrieve(passage[a:b] - lo, term[a:b], threshold)
                out.append((p + lo, part, score))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _retrieve(self, passage, term, threshold):
        count, blocks = int(passage[-1]) + 1, self.blocks
        wide = self.wide[term]
        base = np.bincount(passage[wide], self.top[term[wide]], count)
        p, t = passage[~wide], term[~wide]
        row, at = expand(self.block_at[t], self.block_n[t])
        bound = np.bincount(p[row] * blocks + self.block_of[at], self.block_max[at], count * blocks)
        live = np.flatnonzero((bound.reshape(count, blocks) + base[:, None] >= threshold).ravel())
        starts = np.searchsorted(passage, np.arange(count + 1))
        row, at = expand(starts[live // blocks], np.diff(starts)[live // blocks])
        wanted = term[at] * blocks + (live % blocks)[row]
        slot = np.minimum(np.searchsorted(self.block_key, wanted), len(self.block_key) - 1)
        hit = self.block_key[slot] == wanted
        row, slot = row[hit], slot[hit]
        sub, at = expand(self.posting_at[slot], self.posting_n[slot])
        score = np.bincount(row[sub] * BLOCK_PARTS + self.part[at] % BLOCK_PARTS, self.impact[at], len(live) * BLOCK_PARTS)
        good = np.flatnonzero(score >= threshold)
        where = live[good // BLOCK_PARTS]
        return where // blocks, where % blocks * BLOCK_PARTS + good % BLOCK_PARTS, score[good]

    def matches(self, texts: list[bytes], threshold: float, question: float, answer: float) -> list[list[tuple]]:
        """Per text: (item id, score, question overlap, answer overlap, passages, first word) of every verified item."""
        out: list[list[tuple]] = [[] for _ in texts]
        if not self.items:
            return out
        seqs, where, base, passages = [], [], [], 0
        for t in texts:
            w = words(t)
            ids = np.fromiter(map(self.ids.get, w, repeat(0)), np.int64, len(w))
            seqs.append(ids)
            base.append(passages)
            at = np.flatnonzero(ids)
            # the window that starts at s * STRIDE covers PASSAGE words; the last starts where the text's end is reached
            windows = max(1, -(-max(0, len(ids) - PASSAGE) // STRIDE) + 1) if len(ids) else 0
            if len(at):
                last = np.minimum(at // STRIDE, windows - 1)
                first = np.maximum(0, -(-(at - PASSAGE + 1) // STRIDE))
                row, s = expand(first, last - first + 1)
                where.append((passages + s) * (len(self.ids) + 1) + ids[at][row])
            passages += windows
        if not where:
            return out
        pairs = np.unique(np.concatenate(where))
        p, part, score = self.retrieve(pairs // (len(self.ids) + 1), pairs % (len(self.ids) + 1), threshold)
        text = np.searchsorted(base, p, "right") - 1
        found: dict[tuple[int, int], list] = {}
        for d, q, n, s in zip(text.tolist(), p.tolist(), part.tolist(), score.tolist()):
            found.setdefault((d, self.item_of[n]), []).append((q - base[d], s))
        for (d, n), hits in sorted(found.items()):
            best = None
            for s, x in hits:
                q, a = self.overlap(seqs[d], s * STRIDE, n)
                if best is None or (q + a, x) > (best[0] + best[1], best[2]):
                    best = (q, a, x, s * STRIDE)
            if best[0] >= question and best[1] >= answer:
                out[d].append((self.items[n][0], max(x for _, x in hits), best[0], best[1], len(hits), best[3]))
        return out

    def overlap(self, seq: np.ndarray, start: int, n: int) -> tuple[float, float]:
        """Shares of the item's question and answer runs that stand within an item's length of the passage."""
        question, answer, size = self.runs[n]
        reach = len(self.items[n][1])
        near = run_keys(seq[max(0, start - reach) : start + PASSAGE + reach], size, len(self.ids) + 1)
        share = lambda keys: float(np.isin(keys, near).mean()) if len(keys) else 1.0
        return share(question), share(answer)


def run_keys(seq: np.ndarray, n: int, base: int) -> np.ndarray:
    """One number per run of ``n`` neighbouring word numbers."""
    if len(seq) < n:
        return np.empty(0, np.int64)
    key = np.zeros(len(seq) - n + 1, np.int64)
    for k in range(n):
        key = key * base + seq[k : len(seq) - n + 1 + k]
    return key


def indexes(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """The benchmark's indexes, block by block, with word frequencies over all of it."""
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t")).where("t is not null").distinct()

    def count(batches):
        for b in batches:
            rows = [words(t) for t in raw(b.column(1))]
            part = [(w, 1) for ws in rows for w in {w for w in ws}] + [(None, len(ws)) for ws in rows if ws] + [(b"", 1) for ws in rows if ws]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())], names=["w", "n"])

    counted = items.mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = {r.w: r.n for r in counted.where("w is null or w = X''").collect()}
    if not total:
        return
    total = {None if k is None else bytes(k): n for k, n in total.items()}
    blocks = max(1, -(-(items.agg(F.sum(F.length("t"))).first()[0] or 0) // block_chars))
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        rows = sorted(((r.i, r.t.encode()) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        rows = [r for r in rows if words(r[1])]
        seen = mine.mapInArrow(count, "w binary, n long").where("w is not null and w <> X''").select("w").distinct()
        frequency = {bytes(r.w): r.n for r in counted.join(seen, "w").collect()}
        if rows:
            yield Index(rows, frequency, total[b""], total[None] / total[b""])


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER) -> DataFrame:
    """Add ``leaks`` to every row: an array of (item_id, score, question, answer, passages, first_word), one element an
    item whose question and answer the text holds. A column of that name is replaced."""
    kind = "array<struct<item_id:bigint,score:double,question:double,answer:double,passages:bigint,first_word:bigint>>"
    at = docs.columns.index(text)
    held = list(indexes(benchmark))  # at most BLOCK_CHARS of text each
    columns = [f"__leaks_{k}" for k in range(len(held))]
    out = docs.withColumn(text, F.col(text).cast("string"))
    struct = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()), ("passages", pa.int64()), ("first_word", pa.int64())]))
    names = ["item_id", "score", "question", "answer", "passages", "first_word"]

    def finder(index):
        def run(batches):
            for b in batches:
                rows = []
                for lo in range(0, b.num_rows, 200):
                    rows += index.matches(raw(b.column(at).slice(lo, 200)), threshold, question, answer)
                yield [pa.array([[dict(zip(names, m)) for m in r] for r in rows], struct)]

        return run

    for name, index in zip(columns, held):
        out = arrow_map(out, finder(index), fields(**{name: kind}))
    every = F.concat(*[F.col(c) for c in columns]) if columns else F.array().cast(kind)
    kept = [c for c in out.columns if c not in columns and c.lower() != "leaks"]
    return out.select(*[F.col(f"`{c}`") for c in kept], every.alias("leaks"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` less the rows that hold a benchmark item; columns unchanged."""
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(names)})
    clean = leaks(held, benchmark, f"in_{names.index('text')}").where(F.size("leaks") == 0)
    return clean.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(names)])
