from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from corpuslab.llm import sentencepieces
from corpuslab.llm.sentencepieces import PieceDecoder, PieceEncoder, checked_pieces, decode_pieces, encode_pieces, match_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, original int"
ODD = [
    "", " ", "  ", "a  b", "x\0y z", "\x00", "日本語 \n\n  テスト", " a", "a ", "▁ b ", "▁▁", "a" * 300 + " " + "thethe" * 40, "ﬁ①é",
    "<s> </s> <unk> <0x0A>", "\U0001f600 ok", "x" * 3000, "e\u0301", "tab\tnew\nline",
]


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    rng = random.Random(0)
    alphabet = "abcdeilnorst ▁éß漢\n"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(200)]
    return [*ODD, *made, *("".join(rng.choice("the andi") for _ in range(120)) for _ in range(50))]


def test_ids_are_the_librarys(encoder, library):
    some = texts()
    assert [e.tolist() for e in encoder.encode(some)] == library.encode(some)


def test_small_index_blocks_give_the_same(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "INDEX_CHARS", 50)
    monkeypatch.setattr(sentencepieces, "LONG_WORD", 5)
    some = texts()[:60]
    assert [e.tolist() for e in PieceEncoder(MODEL).encode(some)] == library.encode(some)


def test_forgotten_words_are_learned_again(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "KNOWN_CHARS", 200)
    some, encoder = texts(), PieceEncoder(MODEL)
    got = [e.tolist() for start in range(0, len(some), 7) for e in encoder.encode(some[start:start + 7])]
    assert got == library.encode(some) and len(encoder.number) < len({w for t in some for w in t.split()})


def test_other_models_are_refused(monkeypatch):
    class Unigram(sentencepiece.SentencePieceProcessor):
        def get_score(self, i):
            return -7.25

    monkeypatch.setattr(sentencepieces.sentencepiece, "SentencePieceProcessor", Unigram)
    with pytest.raises(ValueError, match="BPE"):
        PieceEncoder(MODEL)


def test_text_of_ids_is_the_librarys(library):
    decode = PieceDecoder(MODEL).decode
    rng = random.Random(1)
    for ids in [*library.encode(texts()), [], [1, 2], [0], *([rng.randrange(32_000) for _ in range(20)] for _ in range(50))]:
        assert decode(ids) == library.decode(ids)


def test_every_occurrence_is_an_edge(encoder):
    index = encoder.index
    text = "\0the theatre\0then there\0"
    codes = index.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    edges = match_pieces(codes, index)
    stride = index.width + 1
    found = {(k // stride, k % stride) for k in np.flatnonzero(edges >= 0).tolist()}
    vocabulary = {p for p in index.pieces if len(p) > 1}
    want = {(s, n) for s in range(len(text)) for n in range(2, stride) if text[s:s + n] in vocabulary and s + n <= len(text)}
    assert found == want


def test_tables(spark, library):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, "long " * 50_000)] + [(10 + k, t) for k, t in enumerate(ODD)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    coded = encode_pieces(docs, MODEL)
    got = coded.collect()
    want = [(i, None if t is None else library.encode(t)) for i, t in rows]
    assert sorted([(r.doc_id, r.ids) for r in got], key=str) == sorted(want, key=str)
    back = decode_pieces(coded, MODEL).collect()
    assert sorted([(r.doc_id, r.text) for r in back], key=str) == sorted(
        [(i, None if ids is None else library.decode(ids)) for i, ids in want], key=str
    )
    assert encode_pieces(docs.limit(0), MODEL).collect() == []
    want = [
        (i, None, None, True) if ids is None else
        (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), library.decode(ids) == t)
        for (i, t), (_, ids) in zip(rows, want)
    ]
    assert sorted(map(tuple, checked_pieces(docs, MODEL).collect()), key=str) == sorted(want, key=str)
    assert checked_pieces(docs.limit(0), MODEL).collect() == []
