import random
import zlib

import public_tokenizers
import pytest

from millrace.llm.pieces import MARK, Lattice, segment
from millrace.llm.queries_pieces import op1_sentencepiece_nbest
from tests.llm.tables import clashing, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return Lattice(MODEL)


def brute(lattice, text):
    """All paths of a whole text's lattice, best first."""
    data, out = text.encode(), []

    def walk(j, ids, score):
        if j == 0:
            out.append((score, tuple(ids)))
            return
        for start, own, s in lattice._edges_into(data, j):
            walk(start, list(own) + ids, score + s)

    walk(len(data), [], 0)
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["hello", "the a", "aaaaaa", "été", "a\nb", "日本", "𝒳q", "  two", "x\t<s>", "ab ab ab"])
def test_n_best_equals_all_paths_of_the_whole_lattice(lattice, text):
    units = lattice.units(text)
    lattice.learn(units)
    ids, scores, changes = lattice.best(units, 6)
    want = brute(lattice, "".join(units))
    assert scores == [s for s, _ in want[:6]]
    assert lattice.plain(__import__("numpy").frombuffer(ids, "<i4").tolist()) == text
    assert len({tuple(sorted((k, s.ids) for k, s in c.items())) for c in changes}) == len(changes)


def test_units_are_not_crossed_by_pieces(lattice):
    assert not [p for p in lattice.edge if MARK in p.decode().lstrip(MARK)]


def test_long_words_and_ties(lattice):
    word = "ab" * 5000
    lattice.learn([MARK + word, "a" * 300])
    assert lattice.decode(__import__("numpy").frombuffer(lattice.known[MARK + word][0], "<i4").tolist()).decode() == MARK + word
    few = lattice.nbest(b"a" * 300, 5)
    assert len({s.ids for s in few}) == 5 and [s.score for s in few] == sorted((s.score for s in few), reverse=True)
    assert few[0].score == lattice.known["a" * 300][1]


def test_segment_rows(spark, lattice):
    df = clashing(frame(spark), ["score", "IDS"])
    rows = segment(df, MODEL).collect()
    assert len(rows) == df.count()
    for r in rows:
        text = r.text or ""
        assert r.round_trip and r.decoded == text and r.n_pieces == len(r.ids) == r.nbest_pieces[0]
        assert r.nbest_scores == sorted(r.nbest_scores, reverse=True) and r.nbest_scores[0] == r.score
        if not text:
            assert (r.n_pieces, r.score, r.nbest_scores) == (0, 0.0, [0.0])
    assert segment(frame(spark, []), MODEL).count() == 0


def test_long_units_break_ties_as_short_ones_do(lattice):
    """The path of one unit alone is the path that all units of a length get together, equal scores included."""
    rng = random.Random(3)
    units = {MARK + "".join(rng.choice("aab日é") for _ in range(rng.randrange(1, 15))) for _ in range(300)}
    lattice.learn(units)
    for u in units:
        alone = lattice.viterbi(u.encode())
        ids, score, _ = lattice.known[u]
        assert alone.score == score and alone.ids == tuple(int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4))


def test_a_path_that_does_not_decode_to_its_unit_is_noticed(lattice, monkeypatch):
    lattice.learn([MARK + "sound"])
    assert MARK + "sound" not in lattice.broken
    real = lattice.decode
    monkeypatch.setattr(lattice, "decode", lambda ids: real(ids).replace(b"unso", b"osnu"))
    lattice.learn([MARK + "unsound", MARK + "fine"])
    assert lattice.broken == {MARK + "unsound"}
    lattice.broken.clear()


def test_units_that_are_met_again_are_not_forgotten(lattice, monkeypatch):
    from millrace.llm import pieces

    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    words = [MARK + f"w{k}" for k in range(40)]
    lattice.learn(words)
    want = {w: lattice.known[w] for w in words}
    for at in range(0, 40, 4):
        lattice.learn(words[at : at + 4] + words[:2])
        assert all(lattice.known[w] == want[w] for w in words[at : at + 4] + words[:2])


def test_the_query_returns_ids_and_the_text_they_decode_to(spark, lattice, tmp_path):
    texts = ["the cat  sat", "", None, "été 𝒳"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op1_sentencepiece_nbest(spark, str(tmp_path)).collect():
        text = texts[r.doc_id] or ""
        assert r.decoded == text and r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))


def test_pieces_that_share_a_slot_are_found(lattice):
    """One table of chained slots holds every piece; other hashes have no number."""
    import numpy as np

    hashed = np.array([lattice._hash(p) for p in lattice.edge], np.uint64)
    assert (lattice.chained >= 0).sum() > 0
    assert (lattice._find(hashed) == np.arange(len(hashed))).all()
    others = np.setdiff1d(hashed[lattice.chained[:-1] >= 0] + np.uint64(1), hashed)
    assert (lattice._find(others) == -1).all()


def test_sound_units_joined_are_the_decoded_text(lattice):
    """The query's text comes from units that were decoded when they were learned, once each."""
    text = "one two  three\nfour one"
    units, whole = lattice.cut(text)
    lattice.learn(set(units))
    ids, _, _ = lattice.best(units, 4)
    decoded = lattice.decode(__import__("numpy").frombuffer(ids, "<i4").tolist()).decode()
    assert whole and lattice.broken.isdisjoint(units) and decoded == "".join(units)
    assert lattice.spaced(decoded) == lattice.spaced("".join(units)) and not lattice.spaced(decoded).startswith(" ")


@pytest.mark.parametrize("n", [1, 4])
def test_the_text_is_decoded_from_the_ids_of_every_row(spark, monkeypatch, n):
    """Pieces that change after their units were learned show in the decoded text and in the round trip."""
    import pyarrow as pa

    from millrace.llm import pieces

    lattice = Lattice(MODEL)
    lattice.learn(lattice.units("the cat sat"))
    the = lattice.edge[(MARK + "the").encode()][0]
    lattice.surface[the] = (MARK + "teh").encode()
    lattice.pieces = pa.array(lattice.surface, pa.large_binary())
    monkeypatch.setattr(pieces, "kept", lambda key, make: lattice)
    monkeypatch.setattr(pieces, "arrow_map", lambda df, run, add, *rest: (run, add.names))
    texts = ["the cat sat", None, "cat", "", "sat the"]
    run, names = segment(frame(spark, []).select("text"), MODEL, n)
    (out,) = run(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    got = dict(zip(names, (c.to_pylist() for c in out)))
    assert got["decoded"] == ["teh cat sat", "", "cat", "", "sat teh"]
    assert got["round_trip"] == [False, True, True, True, False]


@pytest.mark.parametrize("turned", [False, True])
def test_a_round_trip_is_that_of_the_n_best_of_its_own_text(spark, tmp_path, turned):
    """The second best of a unit does not decode to it: that counts where it is among the n best, whatever other rows hold."""
    import sentencepiece

    model = f"{tmp_path}/small.model"
    with open(model, "wb") as out:
        sentencepiece.SentencePieceTrainer.train(
            sentence_iterator=iter(["ab ba aab bba abab"] * 20), model_writer=out, vocab_size=12, model_type="unigram",
            user_defined_symbols=["日本"], hard_vocab_limit=False, minloglevel=2,
        )
    texts = {"日本": False, "ab 日本 ba abab": True, "日": False, "ab": True}
    rows = [(k, t, "en", "s", None) for k, t in enumerate(texts)]
    found = segment(frame(spark, rows[::-1] if turned else rows).coalesce(1), model).collect()
    assert {r.text: r.round_trip for r in found} == texts
    assert {r.text: r.decoded for r in found if r.text != "日"} == {t: t for t in texts if t != "日"}


def test_a_batch_of_empty_texts(lattice):
    scores, paths = lattice.paths([[], []], 4)
    assert scores == [[0], [0]] and [lattice.decode_all(ids, ends) for ids, ends, _ in paths] == [[b"", b""], [], [], []]


@pytest.mark.parametrize("n", [1, 4])
def test_whole_paths_are_those_of_each_text(lattice, n):
    """Many texts at once: scores, ids and decoded text of each of the n best, against all paths of the text's lattice."""
    texts = [[], lattice.units("the a"), lattice.units("x"), lattice.units("ab ab ab"), [], lattice.units("日本 é"), lattice.units("the a")]
    scores, paths = lattice.paths(texts, n)
    got = [[] for _ in texts]
    for ids, ends, rows in paths:
        decoded = lattice.decode_all(ids, ends)
        for k, a, b, text in zip(rows.tolist(), [0, *ends.tolist()], ends.tolist(), decoded):
            got[k].append(tuple(ids[a:b].tolist()))
            assert text.decode() == "".join(texts[k]) and text == lattice.decode(got[k][-1])
    for units, own, found in zip(texts, scores, got):
        want = brute(lattice, "".join(units))
        value = {path: score for score, path in want}
        assert own == [s for s, _ in want[:n]] == [value[path] for path in found] and len(set(found)) == len(found)
