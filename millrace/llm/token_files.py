"""Token-id files: documents as separately compressed id arrays under one shared zstandard dictionary.

A data set is a folder with the dictionary (``dictionary-<hash>``) and shard files. A shard is

    b"MTOK0001" | 32-byte sha256 of the dictionary | uint32 bytes per id | uint64 documents | uint64 ids
    | int64 document ids | uint64 frame offsets (one more than documents) | frames

all little-endian. Each frame is one document's id array, compressed on its own with the dictionary, so a short
document is read by one seek through the offset index. Documents stand in ascending id order across the shards (null
first; equal ids by a hash of their ids). Shards appear under a name of their own for every attempt; the manifest names
those that count, so a repeated task leaves no half-written or double shard in the data set.

The dictionary is trained on the id arrays of a bounded sample: ``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS``
characters, by hash of the id; where these are too short, as many as give ``SAMPLE_BYTES`` of ids, by hash of id and
text. It is left out only if all such documents together give less. Null texts are empty; every document ends with the end id.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, raw, stored

MAGIC = b"MTOK0001"
HEAD = "<8s32sIQQ"
HEAD_BYTES = struct.calcsize(HEAD)
END = 1
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 50_000, 32_768
SAMPLE_BYTES = 16 * DICTIONARY_BYTES
LEVEL = 1
SHARD_BYTES, SHARDS = 64 << 20, 4
NO_ID = -(1 << 63)


class Encoder:
    """Ids of whole texts by a tokenizer file that drops white space and splits words on their own.

    A text of Latin letters and other ASCII is lower-cased and cut as the file itself cuts it; the pieces go through the
    file's own model without its (here idle) normaliser, once, and are remembered. Any other text is cut at white space:
    words of Latin letters with trailing punctuation are put together from pieces, the rest goes through the whole
    tokenizer. All give what encoding the whole text gives, because the tokenizer's parts never look across ASCII white
    space."""

    #: Letters whose NFC form is themselves and whose lower case is one letter; then ASCII punctuation but the apostrophe.
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
    #: What a text of such letters, ASCII digits, punctuation and white space does not hold.
    ODD = re.compile(r"[^A-Za-zÀ-ÖØ-öø-ÿ!-@\[-`{-~\t-\r ]")
    #: The file's own cut, and the same over such texts in lower case, with the most frequent case first.
    CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PIECE = re.compile(r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[!-/:-@\[-`{-~]+")
    REMEMBERED = 700_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.whole.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self.split, cut = self.splits(path)
        self.cuts = cut == self.CUT
        self.added = [t.content.lower() for t in self.whole.get_added_tokens_decoder().values()]
        self.word: dict[bytes, bytes] = {}
        self.piece: dict[str, bytes] = {}

    @staticmethod
    def splits(path: str) -> tuple[bool, str | None]:
        """Whether the file is of the kind whose words can be encoded on their own, and the pattern that cuts them."""
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        kind = steps == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in parts] == ["Split", "ByteLevel"]
        kind = kind and spec["model"].get("end_of_word_suffix") == "</w>"
        own = kind and parts[0].get("behavior") == "Removed" and parts[0].get("invert")
        return kind, parts[0]["pattern"].get("Regex") if own else None

    def _pieces(self, wanted) -> None:
        """Encode pieces (lower case, without white space) that are not known yet."""
        missing = [p for p in wanted if p not in self.piece]
        for i in range(0, len(missing), 1000):
            part = missing[i : i + 1000]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
            data, width = ids.astype(self.kind).tobytes(), self.width
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            if len(stops) != len(part):
                raise ValueError("the tokenizer does not mark the ends of words")
            self.piece.update((p, data[a:b]) for p, a, b in zip(part, [0, *stops], stops))

    def _cut(self, text: bytes) -> list[str] | None:
        """The pieces of a text that can be cut here as the file cuts it."""
        if not self.cuts:
            return None
        read = text.decode()
        if self.ODD.search(read):
            return None
        read = read.lower()
        return None if any(a in read for a in self.added) else self.PIECE.findall(read)

    def _learn(self, new: list[bytes]) -> None:
        plain, other, wanted = [], [], set()
        match = self.PLAIN.fullmatch
        for w in new:
            m = match(w.decode())
            if m:
                a, b = m[1].lower(), m[2]
                plain.append((w, a, b))
                wanted.add(a)
                if b:
                    wanted.add(b)
            else:
                other.append(w)
        self._pieces(wanted)
        for w, a, b in plain:
            self.word[w] = self.piece[a] + self.piece[b] if b else self.piece[a]
        if other:
            for w, e in zip(other, self.whole.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)):
                self.word[w] = np.array(e.ids, self.kind).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text, without the end id."""
        if not self.split:
            found = self.whole.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, self.kind).tobytes() for e in found]
        if len(self.word) + len(self.piece) > self.REMEMBERED:
            self.word, self.piece = {}, {}
        cut = [self._cut(t) for t in texts]
        self._pieces(set().union(*[c for c in cut if c is not None]))
        odd = [t.split() if c is None else () for c, t in zip(cut, texts)]
        new = set().union(*odd).difference(self.word)
        if new:
            self._learn(sorted(new))
        piece, word = self.piece.__getitem__, self.word.__getitem__
        return [b"".join(map(word, w) if c is None else map(piece, c)) for c, w in zip(cut, odd)]


def dictionary(docs: DataFrame, tokenizer: str, doc_id: str, text: str) -> bytes:
    """The shared dictionary, trained on the bounded sample; empty if there is too little to train on."""
    chosen = docs.select(F.col(doc_id).alias("i")).distinct().orderBy(F.xxhash64("i"), "i").limit(SAMPLE_DOCS)
    short = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).where(F.length("t") <= SAMPLE_CHARS)
    rows = short.join(F.broadcast(chosen), "i").groupBy("i").agg(F.min("t").alias("t")).orderBy("i").collect()
    encoder = Encoder(tokenizer)
    arrays = [a for a in encoder.encode([r.t.encode() for r in rows]) if len(a) >= 16]
    if len(arrays) < 20 or sum(map(len, arrays)) < SAMPLE_BYTES:
        arrays = _larger_sample(short, encoder)
    if len(arrays) < 20 or sum(map(len, arrays)) < SAMPLE_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, arrays, k=64, d=8).as_bytes()


def _larger_sample(short: DataFrame, encoder: Encoder) -> list[bytes]:
    """Id arrays of a share of the distinct documents (i, t) that gives ``SAMPLE_BYTES``, or of all. Very short ones are
    put together, since the trainer wants samples of some length."""
    filled = short.where(F.length(F.trim("t")) > 0)
    chars = filled.agg(F.sum(F.length("t"))).first()[0] or 0
    share = 4 * SAMPLE_BYTES / max(1, chars)  # an id of two bytes stands for four to five characters
    while True:
        some = filled.where(F.pmod(F.xxhash64("i", "t"), F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40)))
        rows = some.distinct().collect()
        arrays, now = [], b""
        for a in encoder.encode([r.t.encode() for r in sorted(rows, key=lambda r: (r.i is not None, r.i or 0, r.t))]):
            now += a
            if len(now) >= 16:
                arrays.append(now)
                now = b""
        if share >= 1 or len(arrays) >= 20 and sum(map(len, arrays)) >= SAMPLE_BYTES:
            return arrays
        share *= 4


def _held(content: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}


def _open(folder: str):
    return pyarrow.fs.FileSystem.from_uri(folder)


def write(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write ``docs``; the manifest has one row a shard: ``place``, ``part`` and ``roll`` (their order),
    ``name``, ``docs``, ``ids``, ``bytes``. Ids are whole numbers; one that occurs very often is spread over parts."""
    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).cast("string").alias("t"))
    spark = docs.sparkSession
    content = dictionary(rows, tokenizer, "i", "t")
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    digest = hashlib.sha256(content).digest()
    with fs.open_output_stream(f"{base}/dictionary-{digest.hex()}") as f:
        f.write(content)

    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("b")).first()
    places = max(1, -(-(size.b or 0) // shard_bytes), min(spark.sparkContext.defaultParallelism * 2, size.n // 500))
    each = -(-size.n // places) if size.n else 1
    hot = rows.groupBy("i").agg(F.count("*").alias("n")).where(F.col("n") > each).select("i", F.ceil(F.col("n") / each).alias("parts"))
    hot = [(r.i, r.parts) for r in hot.collect()]  # at most ``places`` ids
    cuts = rows.agg(F.percentile_approx("i", [k / places for k in range(1, places)] or [0.5], 100 * places)).first()[0] or []
    alone = [b for i, _ in hot if i is not None for b in (i - 1, i)]  # an id that is spread has its place to itself
    bounds = np.array(sorted({*(cuts if places > 1 else []), *alone}), np.int64)
    spread = rows.join(F.broadcast(spark.createDataFrame(hot, "k long, parts long")), F.col("i").eqNullSafe(F.col("k")), "left")
    spread = spread.select(
        "i", "t", F.pmod(F.xxhash64("t"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))

    def encode(batches):
        encoder, compress = kept(("encoder", tokenizer), partial(Encoder, tokenizer)), zstandard.ZstdCompressor(level=LEVEL, **_held(content)).compress
        end = np.array([END], encoder.kind).tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                arrays = [a + end for a in encoder.encode(raw(part.column(1)))]
                counts = [len(a) // encoder.width for a in arrays]
                ids = part.column(0)
                place = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int32)
                place[ids.is_null().to_numpy(zero_copy_only=False)] = -1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), ids, part.column(2), pa.array(counts, pa.int64()),
                     pa.array([zlib.crc32(a) for a in arrays], pa.int64()), pa.array([compress(a) for a in arrays], pa.binary())],
                    names=["place", "i", "part", "n", "h", "frame"],
                )

    width = Encoder(tokenizer).width
    frames = spread.mapInArrow(encode, "place int, i long, part int, n long, h long, frame binary")
    some = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A task sorts a few shards, however many there are.
    dealt = frames.repartition(max(min(places, some), -(-places // SHARDS)), "place", "part")
    dealt = dealt.sortWithinPartitions("place", "part", "i", "n", "h")

    def shards(batches):
        fs, base = _open(folder)
        task, out, held, size = TaskContext.get(), [], [], 0

        def flush():
            ids = np.array([NO_ID if r[1] is None else r[1] for r in held], "<i8")
            offsets = np.concatenate([[0], np.cumsum([len(r[4]) for r in held])]).astype("<u8")
            total = sum(r[3] for r in held)
            name = f"{base}/shard-{uuid.uuid4().hex}-{task.taskAttemptId()}"
            with fs.open_output_stream(name) as f:
                f.write(struct.pack(HEAD, MAGIC, digest, width, len(held), total))
                f.write(ids.tobytes() + offsets.tobytes())
                for r in held:
                    f.write(r[4])
            out.append((held[0][0], held[0][2], len(out), name, len(held), total, int(offsets[-1])))

        for b in batches:
            for r in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 3, 5))):
                if held and ((r[0], r[2]) != (held[0][0], held[0][2]) or size >= shard_bytes):
                    flush()
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            flush()
        if out:
            kinds = [pa.int32()] * 3 + [pa.string()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["place", "part", "roll", "name", "docs", "ids", "bytes"]
            )

    return stored(dealt.mapInArrow(shards, "place int, part int, roll int, name string, docs long, ids long, bytes long"), "manifest")


def read_document(folder: str, name: str, at: int) -> tuple[int | None, np.ndarray]:
    """Id and token ids of document ``at`` of a shard, by its offset index alone."""
    fs, base = _open(folder)
    with fs.open_input_file(name) as f:
        _, digest, width, docs, _ = struct.unpack(HEAD, f.read_at(HEAD_BYTES, 0))
        if not 0 <= at < docs:
            raise IndexError(at)
        key = struct.unpack("<q", f.read_at(8, HEAD_BYTES + 8 * at))[0]
        lo, hi = struct.unpack("<QQ", f.read_at(16, HEAD_BYTES + 8 * docs + 8 * at))
        frame = f.read_at(hi - lo, HEAD_BYTES + 8 * docs + 8 * (docs + 1) + lo)
    ids = zstandard.ZstdDecompressor(**_held(_content(fs, base, digest))).decompress(frame)
    return (None if key == NO_ID else key), np.frombuffer(ids, f"<u{width}")


def _content(fs, base: str, digest: bytes) -> bytes:
    with fs.open_input_file(f"{base}/dictionary-{digest.hex()}") as f:
        content = f.read()
    if hashlib.sha256(content).digest() != digest:
        raise ValueError("the dictionary is not the one that the shard was written with")
    return content


def digests(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the shards back: per document ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers). The manifest has one row a shard; the running
    sum of its counts is the only thing made in one place."""
    spark: SparkSession = manifest.sparkSession
    ordered = sorted(manifest.collect(), key=lambda r: (r.place, r.part, r.roll))
    starts, total = [], 0
    for r in ordered:
        starts.append((r.name, total))
        total += r.ids
    listed = spark.createDataFrame(starts, "name string, start long")
    listed = listed.repartition(max(1, min(len(starts), 4 * spark.sparkContext.defaultParallelism)))

    def run(batches):
        fs, base = _open(folder)
        contents: dict[bytes, bytes] = {}
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_file(name) as f:
                    magic, digest, width, docs, _ = struct.unpack(HEAD, f.read(HEAD_BYTES))
                    if magic != MAGIC:
                        raise ValueError(f"not a shard: {name}")
                    if digest not in contents:
                        contents[digest] = _content(fs, base, digest)
                    opened = zstandard.ZstdDecompressor(**_held(contents[digest]))
                    keys = np.frombuffer(f.read(8 * docs), "<i8").tolist()
                    sizes = np.diff(np.frombuffer(f.read(8 * docs + 8), "<u8").astype(np.int64)).tolist()
                    out = []
                    for key, size in zip(keys, sizes):
                        ids = np.frombuffer(opened.decompress(f.read(size)), f"<u{width}")
                        out.append((None if key == NO_ID else key, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                        start += len(ids)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
