import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_files as T
from millrace.llm.common import scratch
from tests.llm.tables import clashing, documents, frame

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


HARD = ["it's he'll 12 a1b2 #tag!!! end.", "ÀÉß ẞ İ ı ﬁ Å Å é ÿ Ÿ µ ª", "x\x1cy z w\x85v", "<|endoftext|> a<|startoftext|>b <|endof text|>",
        "日本語 テスト 한국어", "σς ΣΑΣ Σ", "... !? (a) b, c; d: -e- 'f' \"g\"", "👍🏽 a👍b", "", "  ", "ǅ ŉ ΐ", "á ë ́x"]


def test_words_on_their_own_give_the_whole_texts_ids(tokenizer):
    texts = HARD + [r[1] or "" for r in documents()]
    got = T.Encoder(FILE).encode([t.encode() for t in texts])
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def expected(tokenizer, rows):
    """Counter of (id, tokens, crc) and, for ids that stand once, their start."""
    ids = [(r[0], np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")) for r in rows]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    at, starts, out = 0, {}, Counter()
    for key, x in ids:
        starts[key] = at if key not in starts else None
        out[key, len(x), zlib.crc32(x.tobytes())] += 1
        at += len(x)
    return out, starts, at


@pytest.mark.parametrize("size", [64 << 20, 3000])
def test_files_read_back_equal_brute_force(spark, tokenizer, size):
    rows = documents() + [(900 + i, t, None, None, None) for i, t in enumerate(HARD)]
    folder = scratch(spark, "t")
    manifest = T.write(clashing(frame(spark, rows), ["start", "i", "n"]), folder, FILE, shard_bytes=size)
    got = T.digests(manifest, folder).collect()
    want, starts, total = expected(tokenizer, rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert all(r.start == starts[r.doc_id] for r in got if starts[r.doc_id] is not None)
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and spans[-1][1] == total and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    shards = manifest.collect()
    one = max(shards, key=lambda r: r.docs)
    key, ids = T.read_document(folder, one.name, one.docs - 1)
    assert (key, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) in want
    with pytest.raises(IndexError):
        T.read_document(folder, one.name, one.docs)


def test_an_id_that_repeats_very_often_is_spread(spark, tokenizer):
    rows = [(5, f"text {i}", None, None, None) for i in range(3000)] + [(i, "alpha beta", None, None, None) for i in range(10)]
    folder = scratch(spark, "t")
    manifest = T.write(frame(spark, rows), folder, FILE, shard_bytes=6000)
    assert manifest.where("part > 0").count() > 0
    got = sorted(T.digests(manifest, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected(tokenizer, rows)[0]


def test_empty_table(spark):
    folder = scratch(spark, "t")
    assert T.digests(T.write(frame(spark, []), folder, FILE), folder).count() == 0


def test_dictionary_is_trained_and_checked(spark):
    rows = [(i, f"some words {i} " * 200, None, None, None) for i in range(400)]
    content = T.dictionary(frame(spark, rows).withColumnsRenamed({"doc_id": "i", "text": "t"}), FILE, "i", "t")
    assert len(content) > 1000
    folder = scratch(spark, "t")
    manifest = T.write(frame(spark, rows), folder, FILE)
    name = manifest.first().name
    fs, base = T._open(folder)
    held = [f.path for f in fs.get_file_info(T.pyarrow.fs.FileSelector(base)) if "dictionary" in f.path][0]
    with fs.open_output_stream(held) as f:
        f.write(b"other")
    with pytest.raises(ValueError, match="dictionary"):
        T.read_document(folder, name, 0)


def test_every_latin_code_point_is_encoded_as_in_the_whole_text(tokenizer):
    texts = [t for c in map(chr, range(0x80, 0x250)) for t in (c, f"a{c}b", f"x{c}", f"{c}y", f"a{c}.", f"{c}{c}")]
    got = T.Encoder(FILE).encode([t.encode() for t in texts])
    wrong = [t for t, ids in zip(texts, got) if np.frombuffer(ids, "<u2").tolist() != tokenizer.encode(t, add_special_tokens=False).ids]
    assert wrong == []


def test_a_table_of_short_documents_gets_a_dictionary(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"word{k}" for k in rng.integers(0, 300, 60)), None, None, None) for i in range(6000)]
    tiny = [(i if i % 7 else None, f"ab{i} cd", None, None, None) for i in range(100_000)]
    for table in (rows, tiny):
        content = T.dictionary(frame(spark, table).withColumnsRenamed({"doc_id": "i", "text": "t"}), FILE, "i", "t")
        assert len(content) > 1000
    few = frame(spark, rows[:300]).withColumnsRenamed({"doc_id": "i", "text": "t"})
    assert T.dictionary(few, FILE, "i", "t") == b""


def test_a_plain_text_is_cut_into_pieces_that_stand_once(tokenizer):
    texts = ["The cat's the the, THE! (the) 'the' we'LL '''s x'st a1b22 C3-Po\x0bÉté.É été", "it's\tÿ~`^_@ don't !'s 's", "K\x0cx\ry\n"]
    encoder = T.Encoder(FILE)
    got = encoder.encode([t.encode() for t in texts])
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
    assert not encoder.word and "the" in encoder.piece and "the," not in encoder.piece
    odd = ["x\x1cy the", "<|EndOfText|> the <|endoftext|>", "ẖ H̱", "3 × 4 ÷ 2", "na me"]
    got = encoder.encode([t.encode() for t in odd])
    for t, ids in zip(odd, got):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_random_plain_texts(tokenizer):
    rng = np.random.default_rng(11)
    letters = [c for c in map(chr, [*range(0x20, 0x7F), *range(0xC0, 0x100), 9, 10, 11, 12, 13]) if c not in "×÷"] + ["'s", "'LL", "'", " "] * 4
    texts = ["".join(rng.choice(letters, 60)) for _ in range(3000)]
    encoder = T.Encoder(FILE)
    got = encoder.encode([t.encode() for t in texts])
    assert not encoder.word
    assert [t for t, ids in zip(texts, got) if np.frombuffer(ids, "<u2").tolist() != tokenizer.encode(t, add_special_tokens=False).ids] == []
