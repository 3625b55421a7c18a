"""A bigram hierarchical Pitman-Yor language model, trained by Gibbs sampling over table seatings.

Every word that occurs as a context is a restaurant; its dishes are the words that follow it. A table opened for a dish
sends one customer to the parent restaurant, which all contexts share; the parent's base is uniform over the known words
and one unknown. The predictive probability of ``w`` after ``u`` is

    (c(u,w) - d t(u,w)) / (s + c(u)) + (s + d t(u)) / (s + c(u)) * P(w)

and P(w) the same over the parent's counts. The contexts' discount comes
from the counts of counts (n1 / (n1 + 2 n2)). ``CHAINS`` independent chains alternate between the contexts, given the
parent's probabilities, and the parent, given the tables the contexts opened. In a sweep all customers of a dish are
reseated at once: its number of tables is drawn from the exact conditional, proportional to a generalised Stirling number
times rate^tables, whatever its count. After ``BURN_IN`` sweeps of both, the next ``KEPT`` are samples; scores use the mean
of the predictive probabilities over the samples of all chains. The share of the parent that is left for new tables is
taken as spread evenly when the contexts are drawn. A dish with one customer has one table, whatever the chain.

Work is dealt by context: a task turns its texts into chunks of ``CHUNK`` tokens and asks each bucket (a range of word
hashes) about its distinct words and the distinct pairs whose context lies there; words that a sample shows to be very
frequent contexts are spread over buckets by the word that follows. The chunk's texts wait as numbers in a file of the
shared folder; its name, new for every attempt, goes with questions and answers. Buckets merge the chunks' counts, exchange numbers
of tables with the buckets of the dishes, and answer every chunk in the order it asked. All of it is packed arrays, so
that a pair costs a few bytes. Words are told apart by 64-bit hashes, the words after one context by the hash's first 40
bits. What is shuffled grows with the distinct pairs of the corpus.

Texts are A-Z lower-cased and cut at ASCII white space; each ends with an end token, which counts as a token. Null and
empty texts are the end token alone. Rows repeat as they are given. Without training rows all probabilities are the
uniform base.
"""

from __future__ import annotations

import math
import pickle
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, raw, scratch, stored

CHUNK = 1_500_000
BUCKET_BYTES = 10 << 20
CHAINS, BURN_IN, KEPT = 3, 4, 2
SAMPLES = CHAINS * KEPT
TABLE, POINTS, CELLS = 1000, 64, 200_000
STRENGTH, ROOT_STRENGTH, ROOT_DISCOUNT = 1.0, 10.0, 0.75
END, BEGIN = b"\n", b"\t"
FOLLOW = 40
HOT_BASE = 1 << 22


def pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, 5))


def unpack(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def five(x: np.ndarray) -> np.ndarray:
    """40-bit numbers as five bytes each."""
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].copy()


def unfive(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b), 8), np.uint8)
    out[:, :5] = b
    return out.view("<u8").ravel()


def bucket_of(hashes: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    return ((hashes >> np.uint64(bits - 16)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)


def held_out(doc_id, folds: int = 5, fold: int = 1) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


class Numbers(dict):
    """Numbers of words, in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Chunk:
    """Texts as token numbers in hash order, with distinct pairs."""

    def __init__(self):
        self.vocab = Numbers({END: 0, BEGIN: 1})
        self.parts, self.docs, self.size = [], [], 0

    def add(self, key, held: bool, text: bytes) -> None:
        words = text.lower().split()
        seq = np.empty(len(words) + 2, np.int32)
        seq[0], seq[-1] = 1, 0
        seq[1:-1] = np.fromiter(map(self.vocab.__getitem__, words), np.int32, len(words))
        self.parts.append(seq)
        self.docs.append((key, held))
        self.size += len(words) + 1

    def close(self):
        """(word hashes ascending, distinct pair keys, pair number of every token, tokens per text, train flag)."""
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, self.vocab), np.uint64, len(self.vocab))
        order = np.argsort(hashed)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        lengths = np.array([len(p) - 1 for p in self.parts])
        key = np.concatenate([rank[p[:-1]] * len(order) + rank[p[1:]] for p in self.parts])
        self.vocab, self.parts = Numbers(), []
        pairs, number = np.unique(key, return_inverse=True)
        train = np.array([not h for _, h in self.docs])
        return hashed[order], pairs, number, lengths, train


def chunks(batches, size: int = CHUNK):
    """(chunk number, Chunk) of a task's rows (id, text)."""
    base, n, now = TaskContext.get().partitionId() << 24, 0, Chunk()
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            for key, text in zip(part.column(0).to_pylist(), raw(part.column(1))):
                now.add(key, held_out(key), text)
                if now.size >= size:
                    yield base + n, now
                    n, now = n + 1, Chunk()
    if now.docs:
        yield base + n, now


def _rows(rows, names, kinds):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _blobs(rows):
    return _rows(rows, ["dst", "src", "blob"], [pa.int64(), pa.int64(), pa.binary()])


def asker(buckets: int, hot: np.ndarray, folder: str):
    """Rows (dst: bucket, src: chunk, blob): what the chunk asks each bucket, with its training counts and the name of
    the file in ``folder`` that holds its texts."""

    def run(batches):
        for number, chunk in chunks(batches):
            name = uuid.uuid4().hex
            words, pairs, at, lengths, train = chunk.close()
            flag = np.repeat(train, lengths)
            count = np.bincount(at[flag], minlength=len(pairs)).astype(np.uint32)
            context, follower = np.divmod(pairs, len(words))
            seen = np.bincount(follower, count, len(words)).astype(np.uint32)
            follow = words[follower] >> np.uint64(64 - FOLLOW)
            place = np.searchsorted(hot, words)
            is_hot = (place < len(hot)) & (hot[np.minimum(place, len(hot) - 1)] == words) if len(hot) else np.zeros(len(words), bool)
            spread = is_hot[context]
            cuts = np.searchsorted(bucket_of(words, buckets), np.arange(buckets + 1))
            plain = np.flatnonzero(~spread)
            plain_cuts = np.searchsorted(context[plain], cuts)
            hot_at = np.flatnonzero(spread)
            hot_bucket = bucket_of(follow[hot_at], buckets, FOLLOW)
            order = np.argsort(hot_bucket, kind="stable")
            hot_at, hot_cuts = hot_at[order], np.searchsorted(hot_bucket[order], np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                lo, hi = cuts[b], cuts[b + 1]
                p, h = plain[plain_cuts[b] : plain_cuts[b + 1]], hot_at[hot_cuts[b] : hot_cuts[b + 1]]
                each = np.bincount(context[p] - lo, minlength=hi - lo).astype(np.uint32)
                out.append((b, number, pack(words[lo:hi], seen[lo:hi], each, five(follow[p]), count[p], place[context[h]].astype(np.uint32), five(follow[h]), count[h], name)))
            begin = int(np.searchsorted(words, np.uint64(xxhash.xxh64_intdigest(BEGIN))))
            _keep(f"{folder}/{name}", chunk, train, lengths, follower[at], begin, cuts, np.where(is_hot, place, -1).astype(np.int32) if is_hot.any() else None)
            yield _blobs(out)

    return run


def _keep(path: str, chunk: Chunk, train, lengths, token, begin: int, cuts, place) -> None:
    """Write a chunk's rows as word numbers (``token``, in hash order), and what else gives its questions' order: the
    number of the start, the first word of each bucket, and the places of spread words (-1: plain) or None."""
    frequent = np.argsort(-np.bincount(token, minlength=cuts[-1]), kind="stable")  # small numbers compress well
    rank = np.empty(len(frequent), np.uint32)
    rank[frequent] = np.arange(len(frequent))
    code = rank[token]
    split = [(code >> np.uint32(8 * k) & np.uint32(255)).astype(np.uint8) for k in range(3 if len(frequent) < 1 << 24 else 4)]
    blob = pack([k for k, _ in chunk.docs], train, lengths.astype(np.uint32), split, frequent.astype(np.uint32), begin, cuts.astype(np.uint32), place)
    fs, base = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_output_stream(base) as f:
        f.write(blob)


def coded(values: np.ndarray) -> tuple:
    """Few different numbers in a byte each: the 255 most frequent, the bytes, and the others as they are."""
    different, code, n = np.unique(values, return_inverse=True, return_counts=True)
    often = np.argsort(-n, kind="stable")
    rank = np.empty(len(often), np.int64)
    rank[often] = np.arange(len(often))
    code = np.minimum(rank[code], 255).astype(np.uint8)
    return different[often[:255]], code, values


def uncoded(common: np.ndarray, code: np.ndarray, rest: np.ndarray) -> np.ndarray:
    out = np.append(common, common[:1])[np.minimum(code, len(common))] if len(common) else np.zeros(0, rest.dtype)
    out[code == 255] = rest
    return out


def _grouped(batches):
    """Rows (dst, src, blob), sorted, as (dst, [(src, unpacked)])."""
    now, held = None, []
    for b in batches:
        for lo in range(0, b.num_rows, 16):
            for dst, src, blob in zip(*(b.column(k).slice(lo, 16).to_pylist() for k in range(3))):
                if held and dst != now:
                    yield now, held
                    held = []
                now = dst
                held.append((src, unpack(blob)))
    if held:
        yield now, held


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=0).astype(np.uint32)


def gather(batches):
    """One state row per bucket: merged words and pairs with training counts, and how each chunk's questions map to them."""
    for bucket, asked in _grouped(batches):
        words, word_at = np.unique(np.concatenate([a[0] for _, a in asked]), return_inverse=True)
        if len(words) >= HOT_BASE:
            raise ValueError("too many words in a bucket; lower BUCKET_BYTES")
        seen = np.bincount(word_at, np.concatenate([a[1] for _, a in asked]), len(words)).astype(np.int64)
        keys, counts, sizes, lo = [], [], [], 0
        for _, (w, _, each, follow, count, hot, hot_follow, hot_count, _) in asked:
            context = np.repeat(word_at[lo : lo + len(w)], each)
            lo += len(w)
            keys += [context.astype(np.uint64) << np.uint64(FOLLOW) | unfive(follow), (hot.astype(np.uint64) + np.uint64(HOT_BASE)) << np.uint64(FOLLOW) | unfive(hot_follow)]
            counts += [count, hot_count]
            sizes.append((len(w), len(follow), len(hot)))
        pairs, pair_at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(pair_at, np.concatenate(counts), len(pairs)).astype(np.int64)
        align, wlo, plo = [], 0, 0
        for (src, a), (nw, npairs, nhot) in zip(asked, sizes):
            own, hot = pair_at[plo : plo + npairs], pair_at[plo + npairs : plo + npairs + nhot]
            align.append((src, _gaps(word_at[wlo : wlo + nw]), np.diff(own, prepend=0).astype(np.int32), np.diff(hot, prepend=0).astype(np.int32), a[8]))
            wlo, plo = wlo + nw, plo + npairs + nhot
        context, follow = (pairs >> np.uint64(FOLLOW)).astype(np.uint32), pairs & np.uint64((1 << FOLLOW) - 1)
        known = count > 0
        stats = [int(seen.sum()), int((seen > 0).sum()), int(known.sum()), int((count == 1).sum()), int((count == 2).sum())]
        hot_context = context >= HOT_BASE
        ids, at = np.unique(context[hot_context], return_inverse=True)
        totals = (ids - HOT_BASE, np.bincount(at, count[hot_context]), np.bincount(at, known[hot_context]))
        blob = pack(words, seen.astype(np.uint32), np.bincount(context[~hot_context], minlength=len(words)).astype(np.uint32), context[hot_context], five(follow), count.astype(np.uint32))
        yield _rows([(bucket, blob, pack(align), stats, pack(*totals))], ["bucket", "state", "align", "stats", "hot"],
                    [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary()])


class State:
    """A bucket's words, pairs and counts."""

    def __init__(self, blob: bytes):
        self.words, self.seen, each, hot, follow, count = unpack(blob)
        self.context = np.concatenate([np.repeat(np.arange(len(self.words)), each), hot.astype(np.int64)])
        self.follow, self.count = unfive(follow), count.astype(np.int64)
        self.open = np.flatnonzero(self.count >= 2)  # pairs whose tables are sampled

    def totals(self, hot: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Customers and least tables of each context, the spread ones (from ``hot``) after the bucket's own."""
        n = len(self.words)
        own = self.context < HOT_BASE
        extra = max(hot, default=-1) + 1
        customers = np.concatenate([np.bincount(self.context[own], self.count[own], n), [hot[k][0] if k in hot else 0 for k in range(extra)]])
        tables = np.concatenate([np.bincount(self.context[own], self.count[own] > 0, n), [hot[k][1] if k in hot else 0 for k in range(extra)]])
        return customers, tables

    def slot(self, context: np.ndarray) -> np.ndarray:
        return np.where(context >= HOT_BASE, context - HOT_BASE + len(self.words), context)


def messages(bucket: int, buckets: int, follow: np.ndarray, values: list[np.ndarray]):
    """Rows to the dishes' buckets: ascending dishes with their values."""
    cuts = np.searchsorted(bucket_of(follow, buckets, FOLLOW), np.arange(buckets + 1))
    for b in range(buckets):
        lo, hi = cuts[b], cuts[b + 1]
        if hi > lo:
            yield b, bucket, pack(five(follow[lo:hi]), *[v[lo:hi].astype(np.uint32) for v in values])


def contexts_of_dishes(buckets: int):
    """First message: in how many contexts each dish is served, and whether its probability is wanted back."""

    def run(batches):
        for b in batches:
            for bucket, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = State(blob)
                follow, at = np.unique(s.follow, return_inverse=True)
                served = np.bincount(at, s.count > 0, len(follow))
                wanted = np.bincount(at[s.open], minlength=len(follow)) > 0
                keep = served > 0
                if out := list(messages(bucket, buckets, follow[keep], [served[keep], wanted[keep]])):
                    yield _blobs(out)

    return run


def first_weights(discount: float):
    """At the dishes: merged numbers of contexts (dst -1 - bucket), and to each asking bucket the dishes' weights in the
    parent with one table a dish, for every chain."""

    def run(batches):
        for bucket, got in _grouped(batches):
            dishes, at = np.unique(np.concatenate([unfive(a[0]) for _, a in got]), return_inverse=True)
            served = np.bincount(at, np.concatenate([a[1] for _, a in got]), len(dishes))
            p = (served - discount).astype(np.float32)
            out, lo = [(-1 - bucket, bucket, pack(five(dishes), served.astype(np.uint32)))], 0
            for src, (follow, _, wanted) in got:
                mine = at[lo : lo + len(follow)]
                lo += len(follow)
                if wanted.any():
                    out.append((src, bucket, pack(*[p[mine[wanted > 0]]] * CHAINS)))
            yield _blobs(out)

    return run


def stirling_rows(top: int, discount: float) -> list[np.ndarray]:
    """Element ``c``: logarithms of the generalised Stirling numbers S(c, 1..c), by their recursion."""
    rows = [np.zeros(0), np.zeros(1)]
    for c in range(1, top):
        row = np.full(c + 1, -np.inf)
        row[:c] = rows[c] + np.log(c - discount * np.arange(1, c + 1))
        row[1:] = np.logaddexp(row[1:], rows[c])
        rows.append(row)
    return rows


def log_factorial(t: np.ndarray) -> np.ndarray:
    x = np.asarray(t, np.float64) + 8
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return series - np.log((x - 1) * (x - 2) * (x - 3) * (x - 4) * (x - 5) * (x - 6) * (x - 7))


def log_stirling(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) for large ``c``: c! / (t! d^t) times the coefficient of z^c in (1 - (1 - z)^d)^t."""
    return math.lgamma(c + 1) - log_factorial(t) - t * math.log(discount) + log_coefficient(c, t, discount)


def log_coefficient(c, t: np.ndarray, discount: float, nodes: int = 48) -> np.ndarray:
    """Log of the coefficient of z^c in (1 - (1 - z)^d)^t, by the trapezoid rule on a parabola through the saddle point
    around the cut of s = 1 - z. ``c``: one number, or one for each ``t``."""
    t, d = np.asarray(t, np.float64), discount
    c = np.broadcast_to(np.asarray(c, np.float64), t.shape)
    lo, hi = np.log(2 / (c + 1)), np.full(len(t), -1e-12)
    for _ in range(26):
        mid = (lo + hi) / 2
        above = (c + 1) * -np.expm1(d * mid) * np.exp((1 - d) * mid) > t * d * -np.expm1(mid)
        hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)
    s = np.exp(lo)
    e, f = -np.expm1(d * lo), -np.expm1(lo)  # 1 - s^d, 1 - s
    slope = (c + 1) / f - t * d * s ** (d - 1) / e
    bend = t * d * ((1 - d) * s ** (d - 2) * e - d * s ** (2 * d - 2)) / e**2 + (c + 1) / f**2
    reach = 1.2 * np.sqrt(45 / np.maximum(slope * s + 2 * bend * s * s, 1e-9))
    y = (np.arange(nodes) + 0.5) / nodes * reach[:, None]
    root = 1 - 1j * y
    w = s[:, None] * root**2
    top = t * np.log(e) - (c + 1) * np.log(f)
    value = np.exp(t[:, None] * np.log(1 - w**d) - (c + 1)[:, None] * np.log(1 - w) - top[:, None]) * root
    area = 2 * s / np.pi * value.real.sum(1) * reach / nodes
    found = top + np.log(np.maximum(area, 1e-300))
    near = np.log((1 - d) * c * (c - 1) / 2) + log_factorial(t) + t * math.log(d) - log_factorial(c)
    return np.where(t == c, c * math.log(d), np.where(t == c - 1, near, found))


def _span(t: np.ndarray, logs: np.ndarray, least: float, most: float) -> tuple[int, int]:
    """Places in ``t`` between which all weight lies, for log rates from ``least`` to ``most``."""
    low, high = logs + t * least, logs + t * most
    return int(np.argmax(low > low.max() - 45)), len(t) - 1 - int(np.argmax((high > high.max() - 45)[::-1]))


def weighty(customers: np.ndarray, least: np.ndarray, most: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tables between which all weight lies, for log rates from ``least`` to ``most``. The mean and variance
    follow from the saddle point of exp(rate / d (1 - (1 - z)^d)); the law is one of a sum of independent events, so
    Bernstein's bound holds."""
    c, d, out = customers.astype(np.float64), discount, []
    for logs in (least, most):
        aim = logs - np.log(c + 1)
        lo, hi = np.minimum(aim / (1 - d), -1.0) - 50, np.full(len(c), -1e-15)
        for _ in range(60):  # log s, for which rate s^(d - 1) = (c + 1) / (1 - s)
            mid = (lo + hi) / 2
            above = (1 - d) * mid - np.log(-np.expm1(mid)) > aim
            hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)
        s, f = np.exp(lo), -np.expm1(lo)
        mean = np.minimum(np.exp(logs) / d * -np.expm1(d * lo), c)
        out.append((mean, np.maximum(mean - (c + 1) * s / (s + (1 - d) * f), 0)))
    (low, v), (high, w) = out
    low, high = low - 18 - np.sqrt(324 + 110 * v), high + 18 + np.sqrt(324 + 110 * w)
    return np.clip(np.floor(low), 1, c).astype(np.int64), np.clip(np.ceil(high), 1, c).astype(np.int64)


def _pick(t: np.ndarray, found: np.ndarray, logs: np.ndarray, u: np.ndarray) -> np.ndarray:
    """For each log rate the number of tables at which the law's running sum passes the share ``u``."""
    mass = t[:, None] * logs
    mass += found[:, None]
    mass -= mass.max(0)
    np.cumsum(np.exp(mass, out=mass), axis=0, out=mass)
    return t[np.minimum((mass < u * mass[-1]).sum(0), len(t) - 1)]


def draw_tables(customers: np.ndarray, rate: np.ndarray, discount: float, rng) -> np.ndarray:
    """Independent draws of t = 1..c with probability proportional to S(c, t) rate^t, whatever the count c. Up to ``TABLE``
    customers the numbers come from the recursion, beyond from the integral, whose smooth part is
    interpolated where more than ``POINTS`` t have weight."""
    logs = np.log(np.maximum(rate, 1e-300))
    order = np.lexsort((logs, customers))
    counts, logs, u = customers[order], logs[order], rng.random(len(order))
    drawn = np.ones(len(order), np.int64)
    known = kept("stirling", dict)  # of this worker
    if discount not in known:
        if len(known) > 1:
            known.clear()
        known[discount] = stirling_rows(TABLE, discount)
    starts = np.flatnonzero(np.diff(counts, prepend=-1)).tolist()
    large = []  # rows of one count and about one rate
    for lo, end in zip(starts, [*starts[1:], len(order)]):
        c = int(counts[lo])
        while lo < end:
            if c <= TABLE:
                hi, t = min(end, lo + max(64, CELLS // c)), np.arange(1, c + 1)
                found = known[discount][c]
                first, last = _span(t, found, logs[lo], logs[hi - 1])
                drawn[lo:hi] = _pick(t[first : last + 1], found[first : last + 1], logs[lo:hi], u[lo:hi])
            else:
                hi = lo + int(np.searchsorted(logs[lo : min(end, lo + 64)], logs[lo] + 0.5, "right"))
                large.append((lo, hi))
            lo = hi
    for k in range(0, len(large), 64):
        some = np.array(large[k : k + 64])
        low, high = weighty(counts[some[:, 0]], logs[some[:, 0]], logs[some[:, 1] - 1], discount)
        points = [
            np.unique(np.rint(np.geomspace(a, b, POINTS)).astype(np.int64)) if b - a >= POINTS else np.arange(a, b + 1)
            for a, b in zip(low.tolist(), high.tolist())
        ]
        stops = np.cumsum([len(t) for t in points])
        smooth = log_coefficient(np.repeat(counts[some[:, 0]], [len(t) for t in points]), np.concatenate(points), discount)
        for (lo, hi), a, b, t, found in zip(some.tolist(), low.tolist(), high.tolist(), points, np.split(smooth, stops[:-1])):
            every = np.arange(a, b + 1)
            found = np.interp(every, t, found) - log_factorial(every) - every * math.log(discount)
            drawn[lo:hi] = _pick(every, found, logs[lo:hi], u[lo:hi])
    out = np.empty(len(order), np.int64)
    out[order] = drawn
    return out


def seat(customers, prior, context, tables, discount, strength, moves, rng, shared: bool, open_=None, gamma=None):
    """Sampled numbers of tables after ``moves`` sweeps. ``customers`` per dish (2 or more), ``prior``: the parent's
    probability, ``context``: the dish's restaurant, ``tables``: each restaurant's tables (changed here unless
    ``shared``), ``open_``: the dishes' tables that these include (else one a dish).

    A sweep draws a gamma variable of shape strength / discount + tables for each restaurant (or takes ``gamma``, drawn
    where all of a shared restaurant is known). Given these the dishes are independent, and each is drawn from its exact
    conditional, all its customers at once."""
    open_ = np.ones(len(customers), np.int64) if open_ is None else open_
    for _ in range(moves):
        drawn = rng.standard_gamma(strength / discount + tables) if gamma is None else gamma
        new = draw_tables(customers, discount * drawn[context] * prior, discount, rng)
        if not shared:
            np.add.at(tables, context, new - open_)
        open_ = new
    return open_


def _folder(path: str, key: int):
    """Rows of one key of a table written by key."""
    fs, base = pyarrow.fs.FileSystem.from_uri(f"{path}/key={key}")
    if fs.get_file_info(base).type == pyarrow.fs.FileType.NotFound:
        return []
    got = pa.dataset.dataset(base, filesystem=fs, format="parquet").to_table(["dst", "src", "blob"])
    return sorted(zip(*(got.column(k).to_pylist() for k in ("dst", "src", "blob"))))


def by_key(rows: DataFrame, name: str) -> str:
    """Write (dst, src, blob) rows so that a task can read those of one ``dst`` from the shared folder."""
    path = scratch(rows.sparkSession, name)
    rows.withColumn("key", F.col("dst")).repartition("key").write.partitionBy("key").parquet(path)
    return path


def own_rows(path: str, bucket: int):
    """A bucket's own arrays of a round."""
    return unpack(_folder(path, -1 - bucket)[0][2])


def sample_contexts(buckets: int, turn: int, path: str, before: str | None, hot: dict[int, tuple], discount: float, gammas, rest, scale):
    """Seatings of a bucket's contexts: its own additional tables (dst: -1 - bucket), the spread contexts' (dst:
    ``1 << 40``) and messages of additional tables to the dishes' buckets. The parent's probabilities come from the weights
    in ``path``, ``rest`` and ``scale`` of each chain; ``before``: the last round's seatings; ``gammas``: of the spread
    contexts, by chain."""

    def run(batches):
        for b in batches:
            for bucket, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = State(blob)
                wanted = np.unique(s.follow[s.open])
                given = [unpack(r[2]) for r in _folder(path, bucket)]
                at = np.searchsorted(wanted, s.follow[s.open])
                _, least = s.totals(hot)
                context, n, m = s.slot(s.context[s.open]), len(s.open), len(s.words)
                last = [x.astype(np.int64) for x in own_rows(before, bucket)] if before else [np.zeros(n, np.int64)] * CHAINS
                prior, drawn = np.empty(CHAINS * n), []
                rng = np.random.default_rng([turn, bucket, 17])
                for chain in range(CHAINS):
                    weight = np.concatenate([g[chain] for g in given]) if given else np.empty(0)
                    prior[chain * n : chain * n + n] = ((weight + rest[chain]) / scale[chain])[at]
                    shape = least[:m] + np.bincount(context[context < m], last[chain][context < m], m)
                    drawn += [rng.standard_gamma(STRENGTH / discount + shape), [gammas[chain].get(k, 0.0) for k in range(len(least) - m)]]
                # all chains at once: the chains' restaurants stand one behind the other
                slots = np.concatenate([context + chain * len(least) for chain in range(CHAINS)])
                found = seat(np.tile(s.count[s.open], CHAINS), prior, slots, None, discount, STRENGTH, 1, rng, True, gamma=np.concatenate(drawn))
                more = list(found.reshape(CHAINS, n) - 1)
                out = [(-1 - bucket, bucket, pack(*[x.astype(np.uint32) for x in more]))]
                spread = context >= m
                ids, to = np.unique(context[spread] - m, return_inverse=True)
                out.append((1 << 40, bucket, pack(ids, *[np.bincount(to, x[spread], len(ids)) for x in more], *[int(x.sum()) for x in more])))
                out += messages(bucket, buckets, wanted, [np.bincount(at, x, len(wanted)) for x in more])
                yield _blobs(out)

    return run


def sample_parent(turn: int, path: str, first: str, words: int, discount: float, gammas):
    """At the dishes: customers of the parent per chain (contexts plus additional tables) and sampled tables (dst: -1 -
    bucket), to each asking bucket the dishes' weights, drawn from the parent's posterior given its seating, and the sums of
    tables and weights per chain (dst: ``1 << 40``)."""

    def run(batches):
        for b in batches:
            for bucket in b.column(0).to_pylist():
                base = _folder(first, -1 - bucket)
                if not base:
                    continue
                dishes, served = unpack(base[0][2])
                dishes, served = unfive(dishes), served.astype(np.int64)
                customers, asked = np.tile(served, (CHAINS, 1)), []
                for _, src, blob in _folder(path, bucket):
                    follow, *more = unpack(blob)
                    at = np.searchsorted(dishes, unfive(follow))
                    asked.append((src, at))
                    for c, m in zip(customers, more):
                        c[at] += m
                rng = np.random.default_rng([turn, bucket, 29])
                tables = np.ones_like(customers)
                chain, many = np.nonzero(customers >= 2)
                tables[chain, many] = seat(customers[chain, many], np.full(len(many), 1 / (words + 1)), chain, None, discount, ROOT_STRENGTH, 1, rng, True, gamma=gammas)
                weight = rng.standard_gamma(customers - discount * tables)
                out = [(-1 - bucket, bucket, pack(five(dishes), *[c.astype(np.uint32) for c in customers], *[t.astype(np.uint32) for t in tables]))]
                out.append((1 << 40, bucket, pack([int(x) for x in tables.sum(1)], [float(x) for x in weight.sum(1)])))
                out += [(src, bucket, pack(*weight[:, at].astype(np.float32))) for src, at in asked]
                yield _blobs(out)

    return run


def answer(kept_turns: list[tuple], hot: dict[int, tuple], words: int, discount: float, root_discount: float):
    """Rows (dst: chunk, src: bucket, blob): for the chunk's words, in its order, the training count, the context's
    customers, its tables and the parent's probability in every sample; for its pairs the mean of customers less discounted
    tables. ``kept_turns``: of each kept round the seatings, the parent's, and by chain the spread contexts' additional
    tables, the parent's customers and its tables."""

    def run(batches):
        for b in batches:
            for bucket, blob, align in zip(*(b.column(k).to_pylist() for k in (0, 1, 2))):
                s = State(blob)
                customers, least = s.totals(hot)
                context, n = s.slot(s.context[s.open]), len(s.words)
                dish = s.words >> np.uint64(64 - FOLLOW)
                tables, root, total = [], [], np.zeros(len(s.open))
                for seated, parents, extra, guests, sent in kept_turns:
                    parent = _folder(parents, -1 - bucket)
                    parent = unpack(parent[0][2]) if parent else None
                    if parent is not None:
                        dishes = unfive(parent[0])
                        at = np.minimum(np.searchsorted(dishes, dish), len(dishes) - 1)
                        hit = dishes[at] == dish
                    for k, m in enumerate(own_rows(seated, bucket)):
                        total += m
                        t = least + np.bincount(context, m, len(least))
                        for h, v in hot.items():
                            t[n + h] = v[1] + extra[k].get(h, 0)
                        tables.append(t.astype(np.uint32))
                        here = np.where(hit, parent[1 + k][at] - root_discount * parent[1 + CHAINS + k][at], 0.0) if parent is not None else np.zeros(n)
                        p = (here + (ROOT_STRENGTH + root_discount * sent[k]) / (words + 1)) / (ROOT_STRENGTH + guests[k])
                        root.append(p.astype(np.float32))
                kept = np.where(s.count > 0, s.count - discount, 0.0).astype(np.float32)
                kept[s.open] = s.count[s.open] - discount * (1 + total / len(tables))
                common, code, kept = coded(kept)
                columns = [s.seen, customers[:n].astype(np.uint32), *[t[:n] for t in tables], *root]
                whole = [customers[n:].astype(np.uint32), *[t[n:] for t in tables]]
                out = []
                for src, word_gaps, pair_gaps, hot_gaps, name in unpack(align)[0]:
                    w, own, spread = np.cumsum(word_gaps.astype(np.int64)), np.cumsum(pair_gaps, dtype=np.int64), np.cumsum(hot_gaps, dtype=np.int64)
                    values = [(common, code[at], kept[at[code[at] == 255]]) for at in (own, spread)]
                    out.append((src, bucket, pack([c[w] for c in columns], *values, whole, name)))
                yield _blobs(out)

    return run


def scorer(tokens: int, words: int, discount: float, folder: str):
    """Scores of each chunk's texts, given the buckets' answers and the texts' file in ``folder``."""

    def run(batches):
        fs, base_path = pyarrow.fs.FileSystem.from_uri(folder)
        for _, got in _grouped(batches):
            answers = [a for _, a in got]
            got.clear()
            if len({a[4] for a in answers}) != 1:
                raise ValueError("the input changed between two passes")
            with fs.open_input_stream(f"{base_path}/{answers[0][4]}") as f:
                keys, train, lengths, split, frequent, begin, cuts, place = unpack(f.read())
            lengths = lengths.astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            token = np.zeros(len(split[0]), np.uint32)
            for k, x in enumerate(split):
                token |= x.astype(np.uint32) << np.uint32(8 * k)
            token = frequent[token].astype(np.int64)
            before = np.concatenate([[begin], token[:-1]])
            before[starts] = begin
            pairs, pair = np.unique(before * len(frequent) + token, return_inverse=True)
            del before
            context, follower = np.divmod(pairs, len(frequent))
            # pairs were asked about by context, then the spread ones by the bucket of the word that follows
            spread = place[context] if place is not None else np.full(len(pairs), -1, np.int32)
            far = np.flatnonzero(spread >= 0)
            far = far[np.argsort(np.searchsorted(cuts, follower[far], "right"), kind="stable")]
            asked = np.concatenate([np.flatnonzero(spread < 0), far])

            def column(k):
                return np.concatenate([a[0][k] for a in answers]).astype(np.float64)

            values = np.concatenate([uncoded(*a[1]) for a in answers] + [uncoded(*a[2]) for a in answers])
            seen, guests = column(0), column(1)
            if len(values) != len(asked) or len(seen) != len(frequent):
                raise ValueError("the input changed between two passes")
            kept = np.empty(len(asked))
            kept[asked] = values
            whole = [np.maximum.reduce([a[3][k] for a in answers]).astype(np.float64) for k in range(1 + SAMPLES)]
            total = guests[context]
            if len(far):
                total = np.where(spread >= 0, whole[0][np.maximum(spread, 0)] if len(whole[0]) else 0, total)
            p = np.zeros(len(context))
            for k in range(SAMPLES):
                t = column(2 + k)[context]
                if len(far):
                    t = np.where(spread >= 0, whole[1 + k][np.maximum(spread, 0)] if len(whole[1 + k]) else 0, t)
                p += np.where(total > 0, (STRENGTH + discount * t) / (STRENGTH + total), 1.0) * column(2 + SAMPLES + k)[follower] / SAMPLES
            answers.clear()
            p += np.where(total > 0, kept / (STRENGTH + total), 0.0)
            log, base = np.log10(p), np.log10((seen + 0.5) / (tokens + 0.5 * (words + 1)))
            out = [
                pa.array(keys, pa.int64()), pa.array(~train), pa.array(lengths, pa.int64()),
                pa.array(np.add.reduceat((seen > 0)[token].astype(np.int64), starts)), pa.array(np.full(len(keys), tokens), pa.int64()),
                pa.array(np.add.reduceat(base[token], starts)), pa.array(np.add.reduceat(log[pair], starts)),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


MESSAGE = "dst long, src long, blob binary"


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("dst").sortWithinPartitions("dst", "src")


def frequent_words(docs: DataFrame, buckets: int, rows: int = 400) -> np.ndarray:
    """Hashes of words that make up more than half a bucket's share of a few texts, ascending. Only the layout depends
    on it."""
    count: dict[bytes, int] = {BEGIN: 0}
    for r in docs.select(F.substring("text", 1, 20_000).alias("text")).limit(rows).collect():
        words = (r.text or "").encode().lower().split()
        for w in words:
            count[w] = count.get(w, 0) + 1
        count[BEGIN] += 1
    total = sum(count.values())
    found = [xxhash.xxh64_intdigest(w) for w, n in count.items() if n > max(20, total / (2 * buckets))]
    return np.array(sorted(found), np.uint64)


def score(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Train on the rows of ``docs(doc_id, text)`` that are not held out and score all: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score and score (log10 probabilities of the text under the smoothed word counts and under
    the model)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(32768, max(4, -(-size // bucket_bytes))))
    hot = frequent_words(rows, buckets)
    state = "bucket long, state binary, align binary, stats array<bigint>, hot binary"
    texts = scratch(spark, "texts")
    fs, base = pyarrow.fs.FileSystem.from_uri(texts)
    fs.create_dir(base, recursive=True)
    states = stored(_dealt(rows.mapInArrow(asker(buckets, hot, texts), MESSAGE)).mapInArrow(gather, state), "states")
    sums = [0] * 5
    spread: dict[int, list] = {}
    for r in states.select("stats", "hot").collect():  # a few numbers a bucket
        sums = [a + b for a, b in zip(sums, r.stats)]
        for k, c, t in zip(*(x.tolist() for x in unpack(r.hot))):
            got = spread.setdefault(k, [0.0, 0.0])
            got[0] += c
            got[1] += t
    tokens, words, tables, ones, twos = sums
    discount, root_discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos))), ROOT_DISCOUNT
    own = states.select("bucket", "state")
    first = by_key(_dealt(own.mapInArrow(contexts_of_dishes(buckets), MESSAGE)).mapInArrow(first_weights(root_discount), MESSAGE), "first")
    rng = np.random.default_rng(41)
    weights, seated, kept = first, None, []
    extra, root_tables = [{} for _ in range(CHAINS)], [words] * CHAINS
    rest, scale = [(ROOT_STRENGTH + root_discount * words) / (words + 1)] * CHAINS, [ROOT_STRENGTH + tables] * CHAINS
    for turn in range(BURN_IN + KEPT):
        gammas = [{h: rng.standard_gamma(STRENGTH / discount + v[1] + e.get(h, 0)) for h, v in spread.items()} for e in extra]
        old = [x for x in (seated, weights) if x and x != first and turn <= BURN_IN]
        seated = by_key(own.mapInArrow(sample_contexts(buckets, turn, weights, seated, spread, discount, gammas, rest, scale), MESSAGE), "seated")
        extra, customers = [{} for _ in range(CHAINS)], [tables] * CHAINS
        for r in _folder(seated, 1 << 40):  # spread contexts: a few numbers a bucket
            ids, *more = unpack(r[2])
            for k in range(CHAINS):
                customers[k] += more[CHAINS + k]
                for h, m in zip(ids.tolist(), more[k].tolist()):
                    extra[k][h] = extra[k].get(h, 0) + m
        gammas = np.array([rng.standard_gamma(ROOT_STRENGTH / root_discount + t) for t in root_tables])
        weights = by_key(own.select("bucket").mapInArrow(sample_parent(turn, seated, first, words, root_discount, gammas), MESSAGE), "parent")
        sums = [unpack(r[2]) for r in _folder(weights, 1 << 40)]
        root_tables = [sum(t[k] for t, _ in sums) for k in range(CHAINS)]
        left = [rng.standard_gamma(ROOT_STRENGTH + root_discount * t) for t in root_tables]  # for new tables, evenly over the words
        rest, scale = [x / (words + 1) for x in left], [left[k] + sum(w[k] for _, w in sums) for k in range(CHAINS)]
        if turn >= BURN_IN:
            kept.append((seated, weights, extra, customers, root_tables))
        for path in old:  # rounds that nothing reads again
            fs, base = pyarrow.fs.FileSystem.from_uri(path)
            fs.delete_dir(base)
    fs.delete_dir(pyarrow.fs.FileSystem.from_uri(first)[1])
    answers = states.select("bucket", "state", "align").mapInArrow(answer(kept, spread, words, discount, root_discount), MESSAGE)
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _dealt(answers).mapInArrow(scorer(tokens, words, discount, texts), result)
