"""Toxicity by compression distance.

Words are serialised to fixed-width codes (the hash of the first four bytes, then the hash of the whole word), so that
a match is worth the same for short and long words and for words of one family. Two zstandard dictionaries are
trained: one on windows of ordinary documents, one on windows of toxic documents cut to what sets them apart (codes
whose document frequency is far higher among toxic documents). A window is compressed against the ordinary dictionary
and against toxic plus ordinary; the difference in length is the evidence of the window. A document's score is a
logistic function of its windows' mean and three largest differences, calibrated on labelled documents that the
dictionaries have not seen.

The model is fitted on a bounded sample: at most ``PER_CLASS`` toxic and twice as many ordinary labelled documents of
at most ``FIT_CHARS`` characters, taken by hash of the id. Scoring covers every window of every document.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fields, fold, raw

PER_CLASS, FIT_CHARS = 1500, 200_000
WINDOW, LEVEL = 16, 6
HALF, PREFIX = 6, 4
TRIM = b".,;:!?\"'()[]{}<>*#$%&|-_"
#: (words per training sample, COVER segment bytes, bytes of the toxic dictionary) that are tried; calibration chooses.
SHAPES = ((2, 24, 1024), (2, 24, 1536), (2, 24, 2048), (3, 36, 3072))
ORDINARY_BYTES = 2048


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; ``weights`` is (bias, mean, top three). Without dictionaries every score is ``prior``."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, float, float]
    prior: float


def codes(text: bytes, cache: dict[bytes, bytes]) -> list[bytes]:
    out = []
    for w in text.lower().split():
        c = cache.get(w)
        if c is None:
            v = w.strip(TRIM) or w
            c = xxhash.xxh64_digest(v[:PREFIX])[:HALF] + xxhash.xxh64_digest(v)[:HALF]
            if len(cache) >= 1_000_000:
                cache.clear()
            cache[w] = c
        out.append(c)
    return out


def windows(text: bytes, cache: dict[bytes, bytes]) -> list[bytes]:
    c = codes(text, cache)
    return [b"".join(c[i : i + WINDOW]) for i in range(0, len(c), WINDOW)]


def compressor(content: bytes):
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=params).compress
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=held).compress


def differences(parts: list[bytes], toxic, ordinary) -> tuple[float, float]:
    """Mean and mean of the three largest length differences, on a log scale; zeros for no window."""
    if not parts:
        return 0.0, 0.0
    gap = sorted((len(ordinary(p)) - len(toxic(p)) for p in parts), reverse=True)
    return float(np.log1p(max(0.0, sum(gap) / len(gap)))), float(np.log1p(max(0.0, sum(gap[:3]) / min(3, len(gap)))))


def trained(samples: list[bytes], size: int, segment: int, dmer: int) -> bytes:
    """A trained dictionary's bytes; with too few samples for the trainer, the samples themselves."""
    total = sum(map(len, samples))
    if len(samples) < 50 or total < 16 * size:
        return b"".join(dict.fromkeys(samples))[-size:]
    return zstandard.train_dictionary(size, samples, k=segment, d=dmer).as_bytes()


def dictionaries(plain: list[bytes], bad: list[bytes], shapes, rng: random.Random, cache: dict) -> tuple[bytes, list[bytes]]:
    """The ordinary dictionary, and the toxic one in each of the ``shapes``."""
    seen = []
    for side in (plain, bad):
        count: Counter[bytes] = Counter()
        for text in side:
            count.update({h for c in set(codes(text, cache)) for h in (c[:HALF], c[HALF:])})
        seen.append(count)
    share = lambda c, n: np.log((c + 0.5) / (n + 1))
    need = max(3, 0.02 * len(bad))
    marks = {h for h, c in seen[1].items() if c >= need and share(c, len(bad)) - share(seen[0][h], len(plain)) > 2.0}
    parts = [w for t in plain for w in windows(t, cache)]
    rng.shuffle(parts)
    marked = [c if c[HALF:] in marks else c[:HALF] for t in bad for c in codes(t, cache) if c[HALF:] in marks or c[:HALF] in marks]
    rng.shuffle(marked)
    toxic = []
    for words, segment, size in shapes:
        toxic.append(trained([b"".join(marked[i : i + words]) for i in range(0, len(marked), words)], size, segment, 8))
    return trained(parts, ORDINARY_BYTES, 16, 6), toxic


def fit(rows: list[tuple[bytes, int]], seed: int = 7) -> Model:
    """Dictionaries and calibration from (text, label) rows; without both labels, a constant score. Calibration is
    cross-fitted: each half is measured with dictionaries of the other; the final dictionaries are of both."""
    rng = random.Random(seed)
    cache: dict[bytes, bytes] = {}
    sides = [sorted(t for t, y in rows if y == k) for k in (0, 1)]
    prior = len(sides[1]) / max(1, len(rows))
    if min(map(len, sides)) < 2:
        return Model(b"", b"", (0.0, 0.0, 0.0), prior)
    for s in sides:
        rng.shuffle(s)
    label, x = [], [[] for _ in SHAPES]
    for a in (0, 1):
        ordinary, toxic = dictionaries(*[s[a::2] for s in sides], SHAPES, rng, cache)
        held = [(windows(t, cache), y) for y in (0, 1) for t in sides[y][1 - a :: 2]]
        label += [y for _, y in held]
        plain_length = compressor(ordinary)
        for k, t in enumerate(toxic):
            length = compressor(t + ordinary)
            x[k] += [differences(p, length, plain_length) for p, _ in held]
    fits = [calibrate(np.array(v), np.array(label, float)) for v in x]
    best = min(range(len(SHAPES)), key=lambda k: fits[k][1])
    ordinary, toxic = dictionaries(*sides, SHAPES[best : best + 1], rng, cache)
    return Model(toxic[0], ordinary, fits[best][0], prior)


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.02) -> tuple[tuple[float, ...], float]:
    """Logistic weights by Newton steps with a small ridge, and the mean log loss."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    keep = ridge * np.diag([1e-3] + [1.0] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-6)[:, None]) + keep, a.T @ (p - y) + keep @ w)
        w = w - np.clip(step, -4, 4)
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return tuple(map(float, w)), float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> list[tuple[bytes, int]]:
    """The bounded sample: labelled documents whose crc32 remainder by 3 is not 1, chosen by hash within each class.
    An id labelled twice counts as toxic if any label says so; null ids and labels are not used."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(fold("doc_id", 3) != 1)
    pick = lambda y, n: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = pick(1, per_class).unionByName(pick(0, 2 * per_class))
    got = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.length("text") <= FIT_CHARS)
    got = got.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return [(t.encode(), int(y)) for _, t, y in sorted(map(tuple, got.collect()))]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return fit(sample(docs, labels, per_class))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7, hide: tuple[str, ...] = ()) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) to every row. Null, empty and blank texts
    have no window and get the score of no evidence. Columns of these names are replaced."""
    at = docs.columns.index(text)

    def run(batches):
        toxic, ordinary, cache = compressor(model.toxic + model.ordinary), compressor(model.ordinary), {}
        for b in batches:
            if model.toxic:
                x = np.array([differences(windows(t, cache), toxic, ordinary) for t in raw(b.column(at))]).reshape(-1, 2)
                p = 1 / (1 + np.exp(-(model.weights[0] + x @ np.array(model.weights[1:]))))
            else:
                p = np.full(b.num_rows, model.prior)
            yield [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return arrow_map(docs.withColumn(text, F.col(text).cast("string")), run, fields(score="double", predicted="int"), hide)


def remove_toxic(docs: DataFrame, labels: DataFrame, source: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` less the rows predicted toxic by a model trained on ``source`` and ``labels``; columns unchanged."""
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(names)})
    judged = score(held, train(source, labels), f"in_{names.index('text')}", threshold).where("predicted = 0")
    return judged.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(names)])
