"""Language identification of code-switched text by a linear-chain conditional random field.

Every word with a letter gets a label, a language. A word's emission score is the sum of the weights of its features:
affixes (first and last one to three characters), character n-grams (two and three, with marks for the word's ends)
and lexicon features (the languages whose lexicon holds the word, or that none does). Transition weights between the
labels of neighbouring words and start weights are learned with them, by maximum likelihood (forward-backward
gradients, Adam). Words are labelled by their marginals from forward-backward; a document's language is the label with
the largest sum of marginals, its score that label's share.

The model is fitted on a bounded sample: at most ``PER_LANG`` documents of at most ``FIT_CHARS`` characters for each of
the ``LANGS`` most frequent languages, chosen by hash of the id. Some of the sample fills the lexicons, the rest gives
training sequences: spans from random places of random documents, of changing languages, as code-switched text has them.
Prediction covers every word of every document.

A task runs the recursion over all words of a slice of documents as one chain, in blocks side by side; at a document's
first word the transition is the start distribution whatever came before, so documents don't touch each other.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, fields, fold

PER_LANG, FIT_CHARS, LANGS = 300, 200_000, 64
#: Weights are kept in this many buckets by hash of the feature.
BUCKETS = 1 << 16
SEQUENCES, LENGTH, SPAN = 1200, 48, (4, 40)
ROUNDS, RATE, RIDGE = 80, 0.1, 1e-4
#: Tokens whose scores a task holds, and characters labelled at once.
CACHE, CHARS = 400_000, 3_000_000
NO_LANG = "und"


LETTERS = regex.compile(r"\p{L}(?:.*\p{L})?", regex.DOTALL)


def core(token: str) -> str:
    """The token from its first letter to its last one; '' without a letter."""
    found = LETTERS.search(token)
    return found[0] if found else ""


#: Odd multipliers, one a kind of feature: two and three characters, first one to three, last one to three.
KINDS = [np.uint64(int.from_bytes(xxhash.xxh64_digest(b"kind %d" % i), "big") | 1) for i in range(8)]


def _bucket(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Bucket of up to three characters (21 bits each) under a kind."""
    key = sum(c << np.uint64(21 * i) for i, c in enumerate(codes))
    return ((key + np.uint64(1)) * KINDS[kind] >> np.uint64(48)).astype(np.int64) % BUCKETS


def features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word number, bucket) arrays, one pair a kind, each in the order of the words (none empty); n-grams see marks at
    the word's ends and count as often as they occur."""
    text = "".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(text, np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 2)
    begins, owner = ends - size - 2, np.repeat(np.arange(len(words)), size + 2)
    out = []
    for k, n in ((0, 2), (1, 3)):
        at = np.flatnonzero(owner[: len(c) - n + 1] == owner[n - 1 :])
        out.append((owner[at], _bucket(k, *(c[at + i] for i in range(n)))))
    for n in (1, 2, 3):
        has = np.flatnonzero(size >= n)
        out.append((has, _bucket(1 + n, *(c[begins[has] + 1 + i] for i in range(n)))))
        out.append((has, _bucket(4 + n, *(c[ends[has] - 1 - n + i] for i in range(n)))))
    return out


@dataclass
class Model:
    """Labels, lexicon (word to the numbers of its languages) and weights: features, then one row a lexicon, then none."""

    labels: list[str]
    lexicon: dict[str, tuple[int, ...]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def rows(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(word number, weight row) arrays of the words' features, those of the lexicons last."""
        none = (len(self.labels),)
        held = [(i, BUCKETS + k) for i, w in enumerate(words) for k in self.lexicon.get(w, none)]
        return [*features(words), tuple(np.array(held, np.int64).reshape(-1, 2).T)]


def emissions(model: Model, words: list[str]) -> np.ndarray:
    """Score of each word (not empty) under each label."""
    out = np.zeros((len(words), len(model.labels)))
    if words:
        for i, row in model.rows(words):
            starts = np.flatnonzero(np.diff(i, prepend=-1))
            if len(starts):
                out[i[starts]] += np.add.reduceat(model.weights[row].astype(np.float64), starts, axis=0)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def marginals(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginal probabilities (words x labels) of a chain of words; ``first`` marks where documents begin.

    The chain is cut into blocks of about the square root of its length. Products of a block's step matrices tell what
    enters the next one from either side; then all blocks run forward and backward side by side."""
    n, k = scores.shape
    width = max(1, int(n**0.5))
    blocks = -(-n // width)
    pad = blocks * width - n
    e = np.exp(np.clip(scores - scores.max(1, keepdims=True), -80, 0))
    e = np.concatenate([e, np.ones((pad, k))]).reshape(blocks, width, k)
    cut = np.concatenate([first, np.ones(pad, bool)]).reshape(blocks, width)
    a, s = np.exp(moves - moves.max()), _unit(np.exp(start - start.max()))
    through = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(width):
        through = np.where(cut[:, t, None, None], through.sum(2, keepdims=True) * s, through @ a) * e[:, t, None, :]
        through = through / through.sum((1, 2), keepdims=True)
    enter, leave = np.empty((blocks, k)), np.empty((blocks, k))
    now = np.full(k, 1 / k)
    for b in range(blocks):
        enter[b] = now
        now = _unit(now @ through[b])
    now = np.full(k, 1 / k)
    for b in range(blocks - 1, -1, -1):
        leave[b] = now
        now = _unit(through[b] @ now)
    out, now = np.empty_like(e), enter
    for t in range(width):
        now = _unit(np.where(cut[:, t, None], now.sum(1, keepdims=True) * s, now @ a) * e[:, t])
        out[:, t] = now
    now = leave
    for t in range(width - 1, -1, -1):
        out[:, t] *= now
        now = _unit(np.where(cut[:, t, None], 1.0, (now * e[:, t]) @ a.T))
    return _unit(out.reshape(-1, k)[:n])


def _expected(e: np.ndarray, a: np.ndarray, s: np.ndarray):
    """Forward-backward over sequences (n, length, labels): log-likelihood's normaliser, marginals, expected moves."""
    n, length, k = e.shape
    alpha, scale = np.empty_like(e), np.empty((n, length, 1))
    now = s * e[:, 0]
    for t in range(length):
        now = now if t == 0 else (alpha[:, t - 1] @ a) * e[:, t]
        scale[:, t] = now.sum(1, keepdims=True)
        alpha[:, t] = now / scale[:, t]
    beta, pairs = np.ones((n, k)), np.zeros((k, k))
    gamma = np.empty_like(e)
    for t in range(length - 1, -1, -1):
        gamma[:, t] = _unit(alpha[:, t] * beta)
        if t:
            into = beta * e[:, t] / scale[:, t]
            pairs += a * (alpha[:, t - 1].T @ into)
            beta = into @ a.T
    return np.log(scale).sum(), gamma, pairs


def learn(sequences: list[list[str]], tags: np.ndarray, labels: list[str], lexicon: dict[str, tuple[int, ...]]) -> Model:
    """Weights from tagged sequences of one length, by maximum likelihood with a ridge."""
    k = len(labels)
    model = Model(labels, lexicon)
    number: dict[str, int] = {}
    ids = np.array([[number.setdefault(w, len(number)) for w in s] for s in sequences])
    word, rows = (np.concatenate(x) for x in zip(*model.rows(list(number))))
    by_word = np.argsort(word, kind="stable")
    word, rows = word[by_word], rows[by_word]
    used, feat = np.unique(rows, return_inverse=True)
    starts = np.searchsorted(word, np.arange(len(number)))
    order = np.argsort(feat, kind="stable")
    by_feature, feature_starts = word[order], np.searchsorted(feat[order], np.arange(len(used)))
    gold = np.eye(k)[tags]
    gold_moves = np.einsum("sti,stj->ij", gold[:, :-1], gold[:, 1:])
    w, moves, start = np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)
    params = [w, moves, start]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = ids.ravel()
    for step in range(1, ROUNDS + 1):
        scores = np.add.reduceat(w[feat], starts, axis=0)[ids]
        e = np.exp(np.clip(scores - scores.max(2, keepdims=True), -80, 0))
        _, gamma, pairs = _expected(e, np.exp(moves), np.exp(start))
        gap = (gamma - gold).reshape(-1, k)
        per_word = np.stack([np.bincount(flat, gap[:, j], len(number)) for j in range(k)], 1)
        grads = [np.add.reduceat(per_word[by_feature], feature_starts, axis=0), pairs - gold_moves, (gamma - gold)[:, 0].sum(0)]
        for p, g, a, b in zip(params, grads, m, v):
            g = g / tags.size + RIDGE * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros((BUCKETS + k + 1, k), np.float32)
    weights[used] = w
    model.weights, model.moves, model.start = weights, moves, start
    return model


def fit(rows: list[tuple[str, str]], seed: int = 11) -> Model:
    """A model from (text, language) rows. With one language it is the answer to all; without rows there is no label."""
    rng = random.Random(seed)
    by_lang: dict[str, list[list[str]]] = {}
    for text, lang in sorted(rows):
        words = [c for c in map(core, text.lower().split()) if c]
        if words:
            by_lang.setdefault(lang, []).append(words)
    labels = sorted(by_lang)
    if len(labels) < 2:
        return Model(labels)
    lexicon: dict[str, tuple[int, ...]] = {}
    spans: list[list[list[str]]] = []
    for k, lang in enumerate(labels):
        held = by_lang[lang]
        rng.shuffle(held)
        cut = len(held) // 2
        seen = Counter(w for words in held[:cut] for w in set(words))
        for w, c in seen.items():
            if c >= 2:
                lexicon[w] = (*lexicon.get(w, ()), k)
        spans.append(held[cut:])
    sequences, tags = [], np.empty((SEQUENCES, LENGTH), np.int64)
    for i in range(SEQUENCES):
        words, k = [], rng.randrange(len(labels))
        while len(words) < LENGTH:
            doc, size = rng.choice(spans[k]), rng.randint(*SPAN)
            at = rng.randrange(max(1, len(doc) - size + 1))
            part = doc[at : at + size][: LENGTH - len(words)]
            tags[i, len(words) : len(words) + len(part)] = k
            words += part
            k = rng.randrange(len(labels))
        sequences.append(words)
    return learn(sequences, tags, labels, lexicon)


def sample(docs: DataFrame, per_lang: int = PER_LANG, langs: int = LANGS) -> list[tuple[str, str]]:
    """The bounded sample: (text, lang) of documents whose crc32 remainder by 3 is not 1. An id that is there several
    times in a language counts once, with its least text; null ids, texts and languages are not used."""
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where("doc_id is not null and lang is not null").where(fold("doc_id", 3) != 1)
    most = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(langs).select("lang")
    h = F.xxhash64("doc_id")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ids = known.select("doc_id", "lang").join(most, "lang", "left_semi").distinct()
    chosen = ids.withColumn("h", h).withColumn("rank", rank).where(F.col("rank") <= per_lang).select("doc_id", "lang")
    # At most langs * per_lang rows of an id and a language: that bound is what is broadcast.
    got = known.where((F.length("text") <= FIT_CHARS)).join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang")
    return [(t, lang) for _, lang, t in got.agg(F.min("text").alias("text")).collect() if t]


def train(docs: DataFrame, per_lang: int = PER_LANG, langs: int = LANGS) -> Model:
    return fit(sample(docs, per_lang, langs))


class Scorer:
    """Emission scores of tokens, held by token up to ``CACHE`` of them."""

    def __init__(self, model: Model):
        self.model, self.at, self.scores = model, {}, np.zeros((0, len(model.labels)))

    def ids(self, tokens: list[str]) -> np.ndarray:
        """Row in ``scores`` of each token, -1 without a letter."""
        new = list(set(tokens).difference(self.at))
        if new:
            words = [core(t) for t in new]
            rows = iter(range(len(self.scores), len(self.scores) + len(new)))
            self.at.update((t, next(rows) if w else -1) for t, w in zip(new, words))
            self.scores = np.concatenate([self.scores, emissions(self.model, [w for w in words if w])])
        return np.fromiter(map(self.at.__getitem__, tokens), np.int64, len(tokens))

    def trim(self) -> None:
        if len(self.at) > CACHE:
            self.at, self.scores = {}, self.scores[:0]


def labelled(scorer: Scorer, texts: list[str | None]):
    """Per text the places of its words with a letter, and their marginals; texts without such a word have none."""
    model = scorer.model
    words = [(text or "").lower().split() for text in texts]
    ends = np.cumsum([len(w) for w in words])
    ids = scorer.ids([w for part in words for w in part])
    keep = ids >= 0
    places = [np.flatnonzero(part) for part in np.split(keep, ends[:-1])]
    sizes, ids = np.array([len(x) for x in places]), ids[keep]
    k = len(model.labels)
    if not len(ids):
        return places, [np.zeros((0, k))] * len(texts)
    ends = np.cumsum(sizes)
    first = np.zeros(len(ids), bool)
    first[(ends - sizes)[sizes > 0]] = True
    probs = np.ones((len(ids), 1)) if k == 1 else marginals(scorer.scores[ids], first, model.moves, model.start)
    return places, np.split(probs, ends[:-1])


def slices(texts: list[str | None], chars: int):
    """The texts in pieces of at most about ``chars`` characters, a text at least."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or "")
    if part:
        yield part


RUNS = "array<struct<lang:string,first_word:int,n_words:int>>"


def identify(docs: DataFrame, model: Model, text: str = "text", runs: bool = False, hide: tuple[str, ...] = ()) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1), ``n_labelled`` (words with a letter) and ``n_switches`` (neighbours among
    them under different labels) to every row; with ``runs`` also the stretches of words of one label, as
    (lang, first_word, n_words) with whitespace-separated words counted from 0 and words with a letter counted.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything under a model without labels.
    Of equal sums the first language in order is taken. Rows that repeat get equal results; columns of these names are
    replaced.
    """
    at = docs.columns.index(text)
    added = fields(lang_pred="string", score="double", n_labelled="long", n_switches="long", **({"runs": RUNS} if runs else {}))

    def run(batches):
        scorer = Scorer(model) if len(model.labels) > 1 else Scorer(Model(model.labels, {}, np.zeros((BUCKETS + 2, len(model.labels)), np.float32)))
        for b in batches:
            pred, score, count, switches, found = [], [], [], [], []
            texts = b.column(at).to_pylist()
            if not model.labels:
                texts = [None] * len(texts)
            for where, probs in (x for part in slices(texts, CHARS) for x in zip(*labelled(scorer, part))):
                count.append(len(where))
                if not len(where):
                    pred.append(NO_LANG), score.append(0.0), switches.append(0), found.append([])
                    continue
                mass = probs.sum(0)
                best = int(mass.argmax())
                tags = probs.argmax(1)
                edge = np.flatnonzero(np.diff(tags)) + 1
                pred.append(model.labels[best]), score.append(min(1.0, float(mass[best] / mass.sum()))), switches.append(len(edge))
                if runs:
                    starts, sizes = np.r_[0, edge], np.diff(np.r_[0, edge, len(tags)])
                    found.append([{"lang": model.labels[tags[s]], "first_word": int(where[s]), "n_words": int(n)} for s, n in zip(starts, sizes)])
            scorer.trim()
            arrays = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(count, pa.int64()), pa.array(switches, pa.int64())]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))
            yield [*arrays, pa.array(found, kind)] if runs else arrays

    return arrow_map(docs.withColumn(text, F.col(text).cast("string")), run, added, hide)
